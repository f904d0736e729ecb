"""Metric queries answered from stored roll-ups, distinct counts among them.

A roll-up holds the partial measures of a metric view by some of its labels. A query is
answered by the smallest roll-up that has its labels, filters and measures; the fact is
not read. Within a batch the finest roll-up comes from the fact and each coarser one from
a finer. New facts are added as further batches: partial results of any batches merge.

Distinct counts are kept as 64-bit words: an id sets one bit of word ``id div 64``, words
of a group are merged by bitwise or, and the set bits are counted at last. That is exact,
merges across labels and batches, and stays in hash aggregation with long buffers. For
dense ids (surrogates) a group takes an eighth of a byte and a little per possible id; ids
far apart take one row each, as a list of distinct ids would. Grouping sets multiply
words, never fact rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.metrics import MetricView, _d, _matches, merge_partials
from tidemark.workspace import child_names, is_complete

_SET = "_set"


@dataclass(frozen=True)
class Rollup:
    """Labels, measures and, by result name, the integer label whose values are counted."""

    labels: Sequence[str]
    measures: Sequence[str] = ()
    distinct: Mapping[str, str] = field(default_factory=dict)

    def holds(self, labels: set[str], measures: set[str], distinct: Mapping[str, str]) -> bool:
        return (
            labels <= set(self.labels)
            and measures <= set(self.measures)
            and all(self.distinct.get(name) == label for name, label in distinct.items())
        )


def words(frame: DataFrame, labels: Sequence[str], ids: str) -> DataFrame:
    """Bit words of the ids of each group; rows without id give none."""
    number = F.col(_d(ids)).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(F.lit(63)).cast("int"))
    return (
        frame.filter(number.isNotNull())
        .groupBy(*[_d(lb) for lb in labels], F.shiftright(number, 6).alias("_word"))
        .agg(F.bit_or(bit).alias("_bits"))
    )


def merge_words(stored: DataFrame, labels: Sequence[str]) -> DataFrame:
    return stored.groupBy(*[_d(lb) for lb in labels], "_word").agg(F.bit_or("_bits").alias("_bits"))


def _sets(frame: DataFrame, sets: Sequence[Sequence[str]], labels: Sequence[str], *always: str):
    return frame.groupingSets(
        [[F.col(c) for c in [*[_d(lb) for lb in s], *always]] for s in sets],
        *[F.col(c) for c in [*[_d(lb) for lb in labels], *always]],
    )


def _set_number(labels: Sequence[str]) -> Column:
    """Which grouping set a row belongs to: one bit for each label that is totalled."""
    number = F.lit(0)
    for position, label in enumerate(labels):
        number = number + F.grouping(_d(label)).cast("int") * F.lit(1 << position)
    return number


class RollupStore:
    """Roll-ups of ``view`` below ``root``; ``lattice`` names them.

    The fact's view is used by ``add`` and by queries that no roll-up holds (where
    ``fall_back`` is set). A batch counts when it is complete in all roll-ups.
    """

    def __init__(self, view: MetricView, root: str, lattice: Mapping[str, Rollup]) -> None:
        if not lattice:
            raise ValueError("a store needs at least one roll-up")
        self.view = view
        self.root = root.rstrip("/")
        self.lattice = dict(lattice)

    # -- storing ---------------------------------------------------------------

    def add(self, batch: str, view: MetricView | None = None) -> None:
        """Store the partial results of one batch of facts; a replayed batch replaces itself.

        ``view`` is the metric view over the batch's rows, by default the whole fact's.
        """
        view = view or self.view
        spark = view.source.sparkSession
        finest_first = sorted(self.lattice, key=lambda n: -len(set(self.lattice[n].labels)))
        done: list[str] = []
        sizes: dict[str, int] = {}
        for name in finest_first:
            rollup = self.lattice[name]
            wanted = set(rollup.labels), set(rollup.measures), rollup.distinct
            finer = [n for n in done if self.lattice[n].holds(*wanted)]
            origin = min(finer, key=lambda n: sizes[n]) if finer else None
            self._write(spark, view, name, batch, origin)
            sizes[name] = spark.read.parquet(self._folder(name, batch, "measures")).count()
            done.append(name)
        spark.createDataFrame(list(sizes.items()), "rollup string, rows long").coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{self.root}/batches/{batch}")

    def _write(self, spark: SparkSession, view: MetricView, name: str, batch: str, origin: str | None) -> None:
        rollup = self.lattice[name]
        aggregates = {m: view._measure(m) for m in rollup.measures}
        if origin:
            finer = spark.read.parquet(self._folder(origin, batch, "measures"))
            partial = merge_partials(finer, rollup.labels, aggregates)
        else:
            partial = view.partials(rollup.labels, rollup.measures)
        partial.write.mode("overwrite").parquet(self._folder(name, batch, "measures"))
        for count, ids in rollup.distinct.items():
            if origin:
                finer = spark.read.parquet(self._folder(origin, batch, f"words-{count}"))
                bits = merge_words(finer, rollup.labels)
            else:
                bits = words(view.label_values([*rollup.labels, ids]), rollup.labels, ids)
            bits.write.mode("overwrite").parquet(self._folder(name, batch, f"words-{count}"))

    def _folder(self, name: str, batch: str, part: str) -> str:
        return f"{self.root}/{name}/{batch}/{part}"

    def batches(self, spark: SparkSession) -> list[str]:
        names = child_names(spark, f"{self.root}/batches")
        return [n for n in names if is_complete(spark, f"{self.root}/batches/{n}")]

    # -- queries ---------------------------------------------------------------

    def choose(
        self, spark: SparkSession, labels: set[str], measures: set[str], distinct: Mapping[str, str]
    ) -> str | None:
        """The roll-up with the fewest stored rows that holds all that is asked for."""
        fit = [n for n, r in self.lattice.items() if r.holds(labels, measures, distinct)]
        complete = self.batches(spark)
        if not fit or not complete:
            return None
        stored = spark.read.parquet(*[f"{self.root}/batches/{b}" for b in complete])
        rows = {r["rollup"]: r["n"] for r in stored.groupBy("rollup").agg(F.sum("rows").alias("n")).collect()}
        known = [n for n in fit if n in rows]
        return min(known, key=lambda n: (rows[n], n)) if known else None

    def query(
        self,
        dimensions: Sequence[str] = (),
        measures: Sequence[str] = (),
        distinct: Mapping[str, str] | None = None,
        filters: Mapping[str, Any] | None = None,
        grouping_sets: Sequence[Sequence[str]] | None = None,
        total_flags: bool = False,
        fall_back: bool = False,
    ) -> DataFrame:
        """As ``MetricView.query``; ``distinct`` maps result names to counted labels.

        Without a roll-up that holds the question this raises, or asks the fact's view.
        """
        spark = self.view.source.sparkSession
        distinct, filters = dict(distinct or {}), dict(filters or {})
        if not measures and not distinct:
            raise ValueError("a query needs a measure or a distinct count")
        outside = {lb for s in grouping_sets or () for lb in s} - set(dimensions)
        if outside:
            raise ValueError(f"grouping sets name labels that are not queried: {sorted(outside)}")
        if grouping_sets is not None and len({frozenset(s) for s in grouping_sets}) < len(grouping_sets):
            raise ValueError("a grouping set is named twice")
        name = self.choose(spark, {*dimensions, *filters}, set(measures), distinct)
        if name is None:
            if not fall_back:
                raise LookupError("no stored roll-up holds these labels and measures")
            extra = {result: ("count_distinct", label) for result, label in distinct.items()}
            return self.view.query(dimensions, measures, extra, filters, grouping_sets, total_flags)
        if not dimensions:
            grouping_sets = None
        result = self._measured(spark, name, dimensions, measures, filters, grouping_sets)
        for count in distinct:
            counted = self._counted(spark, name, count, dimensions, filters, grouping_sets)
            result = _beside(result, counted, dimensions)
        counts = [F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in distinct]
        flags = [
            F.col(_SET).bitwiseAND(F.lit(1 << i)).cast("boolean").cast("int").alias(f"{lb}_is_total")
            for i, lb in enumerate(dimensions)
            if total_flags and grouping_sets is not None
        ]
        return result.select(*[F.col(_d(lb)).alias(lb) for lb in dimensions], *measures, *counts, *flags)

    def _stored(self, spark: SparkSession, name: str, part: str, filters: Mapping[str, Any]) -> DataFrame:
        frame = spark.read.parquet(*[self._folder(name, b, part) for b in self.batches(spark)])
        for label, value in filters.items():
            frame = frame.filter(_matches(F.col(_d(label)), value))
        return frame

    def _measured(self, spark, name, dimensions, measures, filters, grouping_sets) -> DataFrame:
        frame = self._stored(spark, name, "measures", filters)
        results = [
            self.view._measure(m).combine(lambda p, m=m: F.col(f"_p_{m}_{p}")).alias(m) for m in measures
        ]
        results.append(F.sum("_rows").alias("_rows"))
        if grouping_sets is None:
            return frame.groupBy(*[_d(lb) for lb in dimensions]).agg(*results).withColumn(_SET, F.lit(0))
        return _sets(frame, grouping_sets, dimensions).agg(*results, _set_number(dimensions).alias(_SET))

    def _counted(self, spark, name, count, dimensions, filters, grouping_sets) -> DataFrame:
        frame = self._stored(spark, name, f"words-{count}", filters)
        if grouping_sets is None:
            merged = merge_words(frame, dimensions).withColumn(_SET, F.lit(0))
        else:
            bits = F.bit_or("_bits").alias("_bits")
            merged = _sets(frame, grouping_sets, dimensions, "_word").agg(
                bits, _set_number(dimensions).alias(_SET)
            )
        set_bits = F.sum(F.bit_count("_bits")).alias(count)
        if not dimensions:
            return merged.agg(set_bits, F.lit(0).alias(_SET))
        return merged.groupBy(*[_d(lb) for lb in dimensions], _SET).agg(set_bits)


def _beside(left: DataFrame, right: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Counts beside the measures of their groups; a group without any id is only on the left."""
    named = right.select(
        *[F.col(_d(lb)).alias(f"_r{i}") for i, lb in enumerate(dimensions)],
        F.col(_SET).alias("_r_set"),
        *[c for c in right.columns if c != _SET and c not in [_d(lb) for lb in dimensions]],
    )
    same = F.col(_SET) == F.col("_r_set")
    for i, label in enumerate(dimensions):
        same = same & F.col(_d(label)).eqNullSafe(F.col(f"_r{i}"))
    return left.join(named, same, "left").drop("_r_set", *[f"_r{i}" for i in range(len(dimensions))])
