"""Mixing sources to target weights, with DataFrame functions only.

The words of each source are packed into blocks of fixed length. Every output shard
draws a multinomial number of slots for each source. The slots of a source are
numbered through the shards and mapped, pass by pass, through a pseudorandom
permutation of its block numbers; slots and blocks then meet by (source, block).

Everything is a hash of seeds and ids, so that a rerun gives the same mix for any
partitioning. No step needs a source in one task: words are numbered by source and
lane (a hash of the id), and only the lane totals are summed up by source.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, stored, table, tasks

WEIGHTS = (5, 2, 1)
MOST_PASSES = 3


@dataclass(frozen=True)
class Mix:
    """``sources`` (one row each), ``pieces`` (documents cut by block) and ``slots`` (the mix)."""

    sources: DataFrame
    pieces: DataFrame
    slots: DataFrame


def n_words(text: Column) -> Column:
    """The number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Sources with ``source_size``, ``weight`` and ``target``.

    Weights repeat over the sources in code point order, null last. Targets share the
    total size by weight; one that reaches ``MOST_PASSES`` times its source's size
    stays there and the rest is shared again. With the sources in order of
    size/weight, those that stop are a leading run: the first source whose level
    (what is left over, by the weight that is left) lies below its stop ends it. One row per source meets in one
    task, however many documents there are.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    order = [F.col("source_size") / F.col("weight"), F.col("place")]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    cap = F.lit(MOST_PASSES) * F.col("source_size")
    left = F.sum("source_size").over(all_rows) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    weight_left = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    return (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("place", F.row_number().over(by_name).cast("long") - 1)
        .withColumn("weight", F.array(*[F.lit(w) for w in weights])[(F.col("place") % len(weights)).cast("int")].cast("long"))
        .withColumns({"left": left, "weight_left": weight_left})
        .withColumn("level", F.when(cap * F.col("weight_left") >= F.col("left") * F.col("weight"), F.col("left") / F.col("weight_left")))
        .withColumn("level", F.first("level", ignorenulls=True).over(upto))
        .select("source", "place", "source_size", "weight",
                F.when(F.col("level").isNull(), cap.cast("double"))
                .otherwise(F.col("weight") * F.col("level")).alias("target"))
    )


def div(a: Column, b: Column | int) -> Column:
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b).cast("long"))


def permuted(x: Column, n: Column, *key: Column, rounds: int = 4) -> Column:
    """The place of ``x`` in a pseudorandom permutation of 0..n-1 that belongs to ``key``.

    The numbers below a*b, where a = floor(sqrt n) and b = n div a, are pairs
    (high, low) and go through rounds that add to one half a hash of the other, in
    turn. The rounds run over the first a*b numbers and then over the last a*b, so
    that all n take part.
    """
    a = F.greatest(F.floor(F.sqrt(n.cast("double"))), F.lit(1).cast("long"))
    b = div(n, a)

    def mixed(v: Column, first: int) -> Column:
        def step(pair: Column, i: Column) -> Column:
            high, low = pair["high"], pair["low"]
            return F.struct(
                F.when(i % 2 == 0, F.pmod(high + F.pmod(F.xxhash64(low, *key, i), a), a)).otherwise(high).alias("high"),
                F.when(i % 2 == 1, F.pmod(low + F.pmod(F.xxhash64(high, *key, i), b), b)).otherwise(low).alias("low"),
            )

        start = F.struct(div(v, b).alias("high"), F.pmod(v, b).alias("low"))
        numbers = F.array(*[F.lit(i) for i in range(first, first + rounds)])
        return F.aggregate(numbers, start, step, lambda pair: pair["high"] * b + pair["low"])

    once = F.when(x < a * b, mixed(x, 0)).otherwise(x)
    # in a lambda, so that the first half is worked out once
    rest = n - a * b
    return F.transform(F.array(once), lambda v: F.when(v >= rest, rest + mixed(v - rest, 100)).otherwise(v))[0]


def packed(
    docs: DataFrame, id_col: str, text_col: str, source_col: str, lanes: int
) -> DataFrame:
    """Rows with ``id``, ``source``, ``size``, ``print`` and the number ``start`` of their first word in their source.

    ``print`` is a hash of the text. Words are numbered by lane, in a lane by id, size
    and print; rows that agree in all of these may swap places.
    """
    sized = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        n_words(F.col(text_col)).alias("size"),
        F.xxhash64(text_col).alias("print"),
    ).withColumn("lane", F.pmod(F.xxhash64("id", "print"), F.lit(lanes)).cast("int"))
    sized = stored(sized, "mix-sizes")
    lane = Window.partitionBy("source").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        sized.groupBy("source", "lane")
        .agg(F.sum("size").alias("words"))
        .select(F.col("source").alias("s"), F.col("lane").alias("l"), F.coalesce(F.sum("words").over(lane), F.lit(0)).alias("base"))
    )
    inside = Window.partitionBy("source", "lane").orderBy("id", "size", "print").rowsBetween(Window.unboundedPreceding, -1)
    return (
        sized.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(bases, F.col("source").eqNullSafe(F.col("s")) & (F.col("lane") == F.col("l")))
        .select("id", "source", "size", "print", (F.col("base") + F.col("before")).alias("start"))
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    block_words: int = 64,
    shard_slots: int = 4096,
    lanes: int = 1024,
    seed: int = 42,
) -> Mix:
    """Mixes the documents' words to the weights' targets (see ``source_targets``).

    A source has ``n_blocks`` blocks and gets ``n_slots`` of the mix, its target
    divided by the mean words of its blocks. Each slot of a shard draws a source with
    the probability n_slots over all slots; so a shard's counts are multinomial. What
    a source has drawn beyond its slots goes, slot by slot, to sources that have drawn
    too few, so that the totals are met exactly and no block is used more than
    ``MOST_PASSES`` times. A null text has no words; documents without words are in
    no block. A null source is a source of its own.
    """
    rows = stored(packed(docs, id_col, text_col, source_col, lanes), "mix-rows")
    targets = source_targets(rows, weights)
    upto = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    sources = stored(
        targets.withColumn("n_blocks", div(F.col("source_size") + (block_words - 1), block_words))
        .withColumn(
            "n_slots",
            F.coalesce(
                F.round(F.col("n_blocks") * F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size"))).cast("long"),
                F.lit(0).cast("long"),
            ),
        )
        .withColumn("last", F.sum("n_slots").over(upto)),
        "mix-sources",
    )
    named = sources.select(F.col("source").alias("s"), "place", "source_size", "target", "n_blocks")
    rows = rows.join(named, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    block = F.explode(F.sequence(div(F.col("start"), block_words), div(F.col("start") + F.col("size") - 1, block_words)))
    pieces = rows.filter("size > 0").withColumn("block", block).withColumn(
        "words",
        F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
        - F.greatest(F.col("start"), F.col("block") * block_words),
    )
    empty = rows.filter("size = 0").withColumns({"block": F.lit(None).cast("long"), "words": F.lit(0).cast("long")})
    return Mix(sources, pieces.unionByName(empty), _slots(sources, shard_slots, seed))


def _slots(sources: DataFrame, shard_slots: int, seed: int) -> DataFrame:
    """The mix: ``shard``, ``place`` (of the source), ``index`` (of the source's slots), ``pass`` and ``block``."""
    spark = sources.sparkSession
    total = sources.agg(F.coalesce(F.sum("n_slots"), F.lit(0))).first()[0]
    # Sources lie side by side on 0..total-1; cells of that line tell which of them a draw can mean.
    cell = max(1, total // 1024)
    ranges = (
        sources.filter("n_slots > 0")
        .select(F.col("place"), (F.col("last") - F.col("n_slots")).alias("lo"), F.col("last").alias("hi"))
        .withColumn("cell", F.explode(F.sequence(div(F.col("lo"), cell), div(F.col("hi") - 1, cell))))
    )
    draws = spark.range(total).select(
        div(F.col("id"), shard_slots).alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(1, total)).cast("long")).alias("draw"),
    )
    draws = draws.withColumn("cell", div(F.col("draw"), cell))
    drawn = (
        draws.join(ranges, "cell")
        .filter("draw >= lo and draw < hi")
        .groupBy("shard", "place")
        .agg(F.count("*").alias("n"))
    )
    before = Window.partitionBy("place").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    drawn = stored(drawn.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))), "mix-draws")

    got = drawn.groupBy("place").agg(F.sum("n").alias("got"))
    by_place = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    over = F.greatest(F.coalesce(F.col("got"), F.lit(0)) - F.col("n_slots"), F.lit(0))
    under = F.greatest(F.col("n_slots") - F.coalesce(F.col("got"), F.lit(0)), F.lit(0))
    accounts = (
        sources.select("place", "n_slots", "n_blocks")
        .join(got, "place", "left")
        .withColumns({"over": over, "under": under})
        .withColumns({f"{c}_from": F.coalesce(F.sum(c).over(by_place), F.lit(0)) for c in ("over", "under")})
    )
    numbered = (
        # few rows that stand for many slots: dealt out before they are written out
        drawn.repartition(tasks(spark), "shard", "place")
        .withColumn("index", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)))
        .join(accounts, "place")
        .select("shard", "place", "index", "n_slots", "n_blocks", (F.col("over_from") + F.col("index") - F.col("n_slots")).alias("turn"))
    )
    given = (
        accounts.filter("under > 0")
        .withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("under") - 1)))
        .select(
            F.col("place"),
            (F.col("n_slots") - F.col("under") + F.col("k")).alias("index"),
            "n_blocks",
            (F.col("under_from") + F.col("k")).alias("turn"),
        )
    )
    within = numbered.filter("index < n_slots").select("shard", "place", "index", "n_blocks")
    moved = numbered.filter("index >= n_slots").select("shard", "turn").join(given, "turn")
    turn = div(F.col("index"), F.col("n_blocks"))
    return within.unionByName(moved.select("shard", "place", "index", "n_blocks")).select(
        "shard",
        "place",
        "index",
        turn.alias("pass"),
        permuted(F.pmod("index", "n_blocks"), F.col("n_blocks"), F.lit(seed), F.col("place"), turn).alias("block"),
    )


def taken_words(mixed: Mix) -> DataFrame:
    """One row per input row: ``id``, ``print``, ``size``, ``source``, ``source_size``, ``target`` and the words ``taken``."""
    uses = mixed.slots.groupBy("place", "block").agg(F.count("*").alias("uses"))
    row = ["id", "print", "size", "source", "source_size", "target"]
    # a source's rows have different starts as far as they have words
    return (
        mixed.pieces.filter("size > 0")
        .join(uses, ["place", "block"], "left")
        .groupBy("place", "start", *row)
        .agg(F.sum(F.col("words") * F.coalesce(F.col("uses"), F.lit(0))).alias("taken"))
        .select(*row, "taken")
        .unionByName(mixed.pieces.filter("size = 0").select(*row, F.lit(0).cast("long").alias("taken")))
    )


def block_texts(docs: DataFrame, mixed: Mix, id_col: str = "doc_id", text_col: str = "text", block_words: int = 64) -> DataFrame:
    """The mix's blocks as texts: ``shard``, ``place``, ``index`` and ``text``, words parted by a space.

    ``block_words`` is that of ``mix``. A block has at most so many pieces, which meet
    in one group. Rows that repeat an id and its text are interchangeable.
    """
    words = docs.select(F.col(id_col).alias("i"), F.xxhash64(text_col).alias("p"), F.regexp_extract_all(F.col(text_col), F.lit(WORD), F.lit(0)).alias("all")).dropDuplicates(["i", "p"])
    first = F.greatest(F.col("block") * block_words - F.col("start"), F.lit(0)).cast("int")
    cut = F.slice("all", first + 1, F.col("words").cast("int"))
    blocks = (
        mixed.pieces.filter("size > 0")
        .join(words, F.col("id").eqNullSafe(F.col("i")) & (F.col("print") == F.col("p")))
        .select("place", "block", F.struct("start", F.array_join(cut, " ").alias("text")).alias("piece"))
        .groupBy("place", "block")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list("piece")), lambda x: x["text"]), " ").alias("text"))
    )
    return mixed.slots.join(blocks, ["place", "block"]).select("shard", "place", "index", "text")


def mixed_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = 42,
    **options,
) -> DataFrame:
    """The input's rows and columns, each row as often as the mix takes it: up to ``MOST_PASSES`` times or not at all.

    A row stands ``floor(taken/size + u)`` times in the result, u being a hash of its
    id and text between 0 and 1, so that whole documents keep the mix's proportions.
    Rows that repeat an id and its text share what is taken from them. A row without
    words is in no block and goes.
    """
    taken = (
        taken_words(mix(docs, id_col, text_col, source_col, seed=seed, **options))
        .groupBy("id", "print")
        .agg(F.try_divide(F.sum("taken"), F.sum("size")).alias("share"))
        .filter("share > 0")
        .select(F.col("id").alias("__id"), F.col("print").alias("__print"), F.col("share").alias("__share"))
    )
    u = F.pmod(F.xxhash64(F.lit(seed), "__id", "__print"), F.lit(1 << 30).cast("long")) / F.lit(float(1 << 30))
    return (
        docs.join(taken, F.col(id_col).eqNullSafe(F.col("__id")) & (F.xxhash64(text_col) == F.col("__print")))
        .withColumn("__copies", F.floor(F.col("__share") + u))
        .filter("__copies > 0")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
        .select(*[docs[c] for c in docs.columns])
    )


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes of it."""
    taken = taken_words(mix(table(spark, sf_dir, "documents")))
    return taken.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")
