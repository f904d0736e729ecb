"""Near-duplicate embeddings by NN-descent.

Equal vectors are one class. A first neighbour graph comes from several orders of
the classes by random hyperplanes' signs, in which near vectors stand close. It is
refined by local joins: around each class its neighbours, and those that name it as
one, meet and offer each other as neighbours. When the edges near the threshold stop
growing, those that reach it in double precision link their ends.

A list whose last neighbour is still near the threshold is saturated and may lack
some, in its own component and in others. Components with such lists are compared with
each other, block by block, wherever the distance of two of their members and how far
the others lie from these allow a link; what links them makes one component. A crowded
component's links are then counted block by block, so that they are whole however many
there are. Recall is audited on a fixed number of classes against all others; the descent
starts again with longer lists while it is too low, and at last all classes are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table, tasks
from tidemark.llm.components import components

LIST = "array<struct<away:float,id:long>>"
#: Similarities of neighbour lists come from bytes and may be off by this much.
SLACK = 0.02
BLOCK = 256
RUN = 32


@lru_cache(maxsize=8)
def _planes(dim: int, order: int) -> np.ndarray:
    return np.random.default_rng([dim, order]).standard_normal((dim, 32))


def _units(lists: pa.Array) -> list[np.ndarray]:
    out = []
    for x in lists.to_numpy(zero_copy_only=False):
        x = np.asarray(x, "f8")
        x = x / np.abs(x).max()
        out.append(x / np.sqrt(x @ x))
    return out


def _classes(rows: DataFrame) -> DataFrame:
    """One row per distinct vector: ``node``, ``dim``, ``copies``, ``first`` id, ``unit`` (packed doubles) and ``bytes``."""
    grouped = rows.groupBy("node", "vector").agg(F.count("*").alias("copies"), F.min("id").alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = _units(batch.column(1))
            rounded = [np.rint(u / np.abs(u).max() * 127).astype("i1").tobytes() for u in units]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(u) for u in units], pa.int32()),
                    *batch.columns[2:],
                    pa.array([u.tobytes() for u in units], pa.binary()),
                    pa.array(rounded, pa.binary()),
                ],
                names=["node", "dim", "copies", "first", "unit", "bytes"],
            )

    id_type = rows.schema["id"].dataType.simpleString()
    classes = stored(grouped.mapInArrow(run, f"node long, dim int, copies long, first {id_type}, unit binary, bytes binary"), "vectors")
    if not classes.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        raise ValueError("two vectors have one number; number them by another hash")
    return classes


def _nearest(ids: np.ndarray, vectors: np.ndarray, groups: list[tuple[slice, slice]], k: int) -> list[list[dict]]:
    """For each vector the k nearest in what its groups compare it with."""
    flat = vectors.astype("f4")
    length = np.sqrt((flat * flat).sum(1, dtype="f4"))
    out: list[list[dict]] = [[] for _ in ids]
    for own, others in groups:
        away = -((flat[own] @ flat[others].T) / (length[own, None] * length[others][None, :]))
        away[ids[own][:, None] == ids[others][None, :]] = np.inf
        top = np.argpartition(away, min(k, away.shape[1] - 1), axis=1)[:, :k]
        near = np.take_along_axis(away, top, 1)
        names = ids[others][top]
        for i, (n, a) in enumerate(zip(names.tolist(), near.tolist(), strict=True), own.start):
            out[i] += [{"away": d, "id": x} for x, d in zip(n, a, strict=True) if d != np.inf]
    return out


def _ordered(classes: DataFrame, orders: int, k: int) -> DataFrame:
    """Offers of neighbours: ``node`` and a list, from each order by signs."""

    def signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, dims, data = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_pylist()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = np.stack([np.frombuffer(data[i], "i1") for i in at]).astype("f8")
                for o in range(orders):
                    pattern = (x @ _planes(int(dim), o) > 0) @ (1 << np.arange(31, -1, -1, dtype="i8"))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), o, "i4")), pa.array(np.full(len(at), dim, "i4")), pa.array(pattern), pa.array(nodes[at]), pa.array([data[i] for i in at], pa.binary())],
                        names=["order", "dim", "pattern", "node", "bytes"],
                    )

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.column(0).to_numpy().astype("i8") << 32 | batch.column(1).to_numpy()
            ids, data = batch.column(3).to_numpy(), batch.column(4).to_pylist()
            for part in np.split(np.arange(len(ids)), np.flatnonzero(np.diff(kind)) + 1):
                if len(part) < 2:
                    continue
                x = np.stack([np.frombuffer(data[i], "i1") for i in part])
                steps = range(0, len(part), RUN)
                groups = [(slice(s, min(s + RUN, len(part))), slice(max(0, s - RUN // 2), min(s + RUN + RUN // 2, len(part)))) for s in steps]
                found = _nearest(ids[part], x, groups, k)
                yield pa.RecordBatch.from_arrays([pa.array(ids[part]), pa.array(found, pa.list_(pa.struct([("away", pa.float32()), ("id", pa.int64())])))], names=["node", "near"])

    key = ["order", "dim", "pattern", "node"]
    marked = stored(classes.select("node", "dim", "bytes").mapInArrow(signs, "order int, dim int, pattern long, node long, bytes binary"), "orders")
    return marked.repartitionByRange(tasks(classes.sparkSession), *key).sortWithinPartitions(*key).mapInArrow(runs, f"node long, near {LIST}")


def _best(offers: DataFrame, k: int) -> DataFrame:
    """The k nearest of all that a node was offered."""
    return offers.groupBy("node").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))), 1, k).alias("near"))


def _local_joins(lists: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """Around each node its k neighbours and up to k that name it, nearest first, offer each other."""
    named = lists.select(F.col("node").alias("center"), F.posexplode("near").alias("place", "entry"))
    out = named.select("center", F.col("entry.id").alias("node"))
    by_distance = Window.partitionBy("center").orderBy("away", "node")
    back = (
        named.select(F.col("entry.id").alias("center"), F.col("center").alias("node"), F.col("entry.away").alias("away"))
        .withColumn("nth", F.row_number().over(by_distance))
        .filter(F.col("nth") <= k)
        .select("center", "node")
    )
    own = lists.select(F.col("node").alias("center"), "node")
    members = out.union(back).union(own).distinct().join(classes.select("node", "bytes"), "node")

    def meet(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("node", ignore_index=True)
        ids, x = part["node"].to_numpy(), np.stack([np.frombuffer(b, "i1") for b in part["bytes"]])
        whole = slice(0, len(ids))
        return pd.DataFrame({"node": ids, "near": _nearest(ids, x, [(whole, whole)], max(4, k // 2))})

    return members.groupBy("center").applyInPandas(meet, f"node long, near {LIST}")


def _linked(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """The pairs whose cosine in double precision is at least ``least``."""
    a = classes.select(F.col("node").alias("a"), F.col("unit").alias("x"))
    b = classes.select(F.col("node").alias("b"), F.col("unit").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cosine = [np.frombuffer(x, "f8") @ np.frombuffer(y, "f8") for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(np.array(cosine, "f8") >= least))

    return pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _crowded(lists: DataFrame, found: DataFrame, classes: DataFrame, saturated) -> DataFrame:
    """``node``, ``component``, ``dim``, ``unit``, ``copies`` of the members of components with a saturated list; a node without links is one, too."""
    named = classes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "dim", "unit", "copies")
    full = stored(lists.filter(saturated).select("node").join(named, "node").select("component").distinct(), "full")
    return stored(named.join(full, "component"), "crowded")


def _possible(crowded: DataFrame, least: float) -> DataFrame:
    """Pairs of components (``ca`` < ``cb``) that may have links between them, ``limit_a`` and ``limit_b``: how far from the other's hub a member with a link can lie.

    A component's hub is its smallest member, its ``radius`` the largest angle between the
    hub and a member. Members of two components are linked only if their hubs' angle is at
    most both radii and the angle of the threshold.
    """
    reach = float(np.arccos(least)) + 1e-6
    hubs = stored(crowded.groupBy("component").agg(F.min(F.struct("node", "dim", "unit")).alias("hub")).select("component", F.col("hub.dim").alias("dim"), F.col("hub.unit").alias("hub")), "hubs")
    far = crowded.join(hubs.select("component", "hub"), "component").select("component", "unit", "hub").mapInArrow(_angles, "component long, angle double")
    hubs = stored(hubs.join(far.groupBy("component").agg(F.max("angle").alias("radius")), "component"), "hubs")
    sizes = stored(hubs.groupBy("dim").agg(F.ceil(F.count("*") / (4 * BLOCK)).cast("int").alias("blocks")), "hub-blocks")
    dealt = (
        hubs.join(sizes, "dim")
        .withColumn("own", F.pmod(F.xxhash64("component"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("dim", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "component", "hub", "radius")
    )

    def meet(part: pd.DataFrame) -> pd.DataFrame:
        x, y = (part[part["own"] == part[k].iloc[0]] for k in ("i", "j"))
        if not len(x) or not len(y):
            return pd.DataFrame({"ca": np.zeros(0, "i8"), "cb": np.zeros(0, "i8"), "limit_a": np.zeros(0), "limit_b": np.zeros(0)})
        u, v = (np.stack([np.frombuffer(b, "f8") for b in p["hub"]]) for p in (x, y))
        r, q, a, b = x["radius"].to_numpy(), y["radius"].to_numpy(), x["component"].to_numpy(), y["component"].to_numpy()
        near = np.arccos(np.clip(u @ v.T, -1, 1)) <= r[:, None] + q[None, :] + reach
        near &= a[:, None] < b[None, :] if part["i"].iloc[0] == part["j"].iloc[0] else True
        at, to = np.nonzero(near)
        turned = a[at] > b[to]
        out = {"ca": np.where(turned, b[to], a[at]), "cb": np.where(turned, a[at], b[to])}
        return pd.DataFrame(out | {"limit_a": np.where(turned, r[at], q[to]) + reach, "limit_b": np.where(turned, q[to], r[at]) + reach})

    pairs = dealt.groupBy("dim", "i", "j").applyInPandas(meet, "ca long, cb long, limit_a double, limit_b double")
    a, b = hubs.select(F.col("component").alias("ca"), F.col("hub").alias("hub_a")), hubs.select(F.col("component").alias("cb"), F.col("hub").alias("hub_b"))
    return pairs.join(a, "ca").join(b, "cb")


def _angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first column and the angle between the vectors in the second and the third one."""
    for batch in batches:
        cosine = [np.frombuffer(x, "f8") @ np.frombuffer(y, "f8") for x, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.arccos(np.clip(np.array(cosine, "f8"), -1, 1)))], names=["component", "angle"])


def _linked_across(crowded: DataFrame, least: float) -> DataFrame:
    """Links (``a``, ``b``) between crowded components: at least one between any two that have some."""
    pairs = stored(_possible(crowded, least), "possible")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cosine = [np.frombuffer(x, "f8") @ np.frombuffer(y, "f8") for x, y in zip(batch.column("unit").to_pylist(), batch.column("hub").to_pylist(), strict=True)]
            angle = np.arccos(np.clip(np.array(cosine, "f8"), -1, 1))
            yield batch.select(["ca", "cb", "side", "node", "unit"]).filter(pa.array(angle <= batch.column("limit").to_numpy()))

    sides = [
        pairs.select("ca", "cb", F.lit(0).alias("side"), F.col("limit_a").alias("limit"), F.col("hub_b").alias("hub"), F.col("ca").alias("component")),
        pairs.select("ca", "cb", F.lit(1).alias("side"), F.col("limit_b").alias("limit"), F.col("hub_a").alias("hub"), F.col("cb").alias("component")),
    ]
    members = sides[0].union(sides[1]).join(crowded.select("component", "node", "unit"), "component").select("ca", "cb", "side", "limit", "hub", "node", "unit")
    members = stored(members.mapInArrow(close, "ca long, cb long, side int, node long, unit binary"), "reaching")
    blocks = lambda side: F.ceil(F.count(F.when(F.col("side") == side, 1)) / BLOCK).cast("int")
    sizes = stored(members.groupBy("ca", "cb").agg(blocks(0).alias("n"), blocks(1).alias("m")).filter("n > 0 and m > 0"), "reaching-sizes")
    own = F.pmod(F.xxhash64("node"), F.when(F.col("side") == 0, F.col("n")).otherwise(F.col("m"))).cast("int")
    dealt = (
        members.join(sizes, ["ca", "cb"])
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("side") == 0, F.col("m")).otherwise(F.col("n")) - 1)))
        .select("ca", "cb", F.when(F.col("side") == 0, F.col("own")).otherwise(F.col("other")).alias("i"), F.when(F.col("side") == 0, F.col("other")).otherwise(F.col("own")).alias("j"), "side", "node", "unit")
    )

    def meet(part: pd.DataFrame) -> pd.DataFrame:
        x, y = part[part["side"] == 0], part[part["side"] == 1]
        if not len(x) or not len(y):
            return pd.DataFrame({"a": np.zeros(0, "i8"), "b": np.zeros(0, "i8")})
        u, v = (np.stack([np.frombuffer(b, "f8") for b in p["unit"]]) for p in (x, y))
        at, to = (w[:1] for w in np.nonzero(u @ v.T >= least))
        return pd.DataFrame({"a": x["node"].to_numpy()[at], "b": y["node"].to_numpy()[to]})

    return dealt.groupBy("ca", "cb", "i", "j").applyInPandas(meet, "a long, b long")


def _compared(classes: DataFrame, found: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """Components and link counts as of ``_descent``, by comparing all classes; ``found`` holds components known before."""
    named = classes.join(found, "node", "left").select("node", F.col("dim").cast("long").alias("component"), F.coalesce("component", "node").alias("known"), "unit", "copies")
    met = stored(_met_in_blocks(stored(named, "compared"), least), "met")
    known = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    linked = met.filter("linked > 0").groupBy("node").agg(F.sum("linked").alias("linked"))
    return components(known.union(met.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))), stored(linked, "link-counts")


def _counted_in_blocks(members: DataFrame, least: float) -> DataFrame:
    """For each node of ``members`` (node, component, unit, copies): the copies of all it is linked with, ``linked``."""
    met = _met_in_blocks(members.withColumn("known", F.col("component")), least)
    return met.groupBy("node").agg(F.sum("linked").alias("linked"))


def _met_in_blocks(members: DataFrame, least: float) -> DataFrame:
    """For each node of ``members`` (node, component, known, unit, copies) and block of its component the copies of
    all it is linked with, ``linked``; and with ``other`` one node of each other ``known`` that it is linked with, counting 0."""
    # written, so that the join with it can split a component that holds most rows
    sizes = stored(members.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "component-sizes")
    dealt = (
        members.join(sizes, "component")
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "known", "unit", "copies")
    )

    def meet(part: pd.DataFrame) -> pd.DataFrame:
        i, j = part["i"].iloc[0], part["j"].iloc[0]
        x, y = part[part["own"] == i], part[part["own"] == j]
        if not len(x) or not len(y):
            return pd.DataFrame({"node": np.zeros(0, "i8"), "linked": np.zeros(0, "i8"), "other": pd.array([], "Int64")})
        u, v = (np.stack([np.frombuffer(b, "f8") for b in p["unit"]]) for p in (x, y))
        a, b = x["node"].to_numpy(), y["node"].to_numpy()
        hit = (u @ v.T >= least) & (a[:, None] != b[None, :])
        counts = [(a, hit @ y["copies"].to_numpy())]
        if i != j:
            counts.append((b, hit.T @ x["copies"].to_numpy()))
        kind, of = x["known"].to_numpy(), y["known"].to_numpy()
        at, to = np.nonzero(hit & (kind[:, None] != of[None, :]))
        _, first = np.unique(np.stack([at, of[to]]), axis=1, return_index=True)
        at, to = at[first], to[first]
        none = [pd.array([pd.NA] * len(n), "Int64") for n, _ in counts]
        parts = [pd.DataFrame({"node": n, "linked": c, "other": o}) for (n, c), o in zip(counts, none, strict=True)]
        return pd.concat([*parts, pd.DataFrame({"node": a[at], "linked": np.zeros(len(at), "i8"), "other": pd.array(b[to], "Int64")})])

    return dealt.groupBy("component", "i", "j").applyInPandas(meet, "node long, linked long, other long")


def _audited(classes: DataFrame, counted: DataFrame, crowded: DataFrame, least: float, probes: int) -> float:
    """The mean share of a class's links that was found, in crowded components or out of them, whichever is less.

    It is taken over those of ``probes`` classes of either kind, chosen by hash, that have links; 1 if none has.
    """
    kinds = [classes.join(crowded.select("node"), "node", kind).select("node", "unit").orderBy(F.xxhash64("node"), "node").limit(probes).toPandas() for kind in ("left_semi", "left_anti")]
    queries = pd.concat(kinds, ignore_index=True)
    inside = set(kinds[0]["node"].tolist())
    units = [np.frombuffer(b, "f8") for b in queries["unit"]]
    dims = {len(u) for u in units}
    shared = classes.sparkSession.sparkContext.broadcast({d: (queries["node"].to_numpy()[[len(u) == d for u in units]], np.stack([u for u in units if len(u) == d])) for d in dims})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                nodes, copies = part.column(0).to_numpy(), part.column(2).to_numpy()
                x = [np.frombuffer(b, "f8") for b in part.column(1).to_pylist()]
                for dim, (names, u) in shared.value.items():
                    at = [i for i, v in enumerate(x) if len(v) == dim]
                    if at:
                        hit = (u @ np.stack([x[i] for i in at]).T >= least) & (names[:, None] != nodes[at][None, :])
                        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(hit @ copies[at])], names=["node", "true"])

    truth = classes.select("node", "unit", "copies").mapInArrow(run, "node long, true long").groupBy("node").agg(F.sum("true").alias("true"))
    both = truth.filter(F.col("true") > 0).join(counted, "node", "left").select("node", (F.coalesce("linked", F.lit(0)) / F.col("true")).alias("share")).collect()
    shares = [[r["share"] for r in both if (r["node"] in inside) == kind] for kind in (True, False)]
    return min((float(np.mean(x)) for x in shares if x), default=1.0)


def near_vectors(
    table_: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    least: float = 0.95,
    neighbours: int = 12,
    orders: int = 8,
    most_rounds: int = 8,
    probes: int = 1024,
    recall: float = 0.95,
    attempts: int = 3,
) -> DataFrame:
    """One row per row: its id, ``n_links``, ``component_id`` and ``kept``.

    Rows are linked when their vectors' cosine is at least ``least``; vectors of different
    lengths are not. Vectors that are null or empty, all zero, or hold null or
    non-finite components are linked with nothing. ``component_id`` is the smallest id that links lead to. Every link is
    confirmed in double precision; links may be missed. If the audit on ``probes``
    classes in crowded components and as many others finds less than ``recall`` of a
    class's links on average, the descent is run again with twice the ``neighbours`` and
    ``orders``, up to ``attempts`` times in all; if that is not enough, all classes are
    compared with each other, which misses none.
    """
    vector = F.transform(F.col(vector_col).cast("array<double>"), lambda x: x + F.lit(0.0))
    rows = table_.select(F.col(id_col).alias("id"), vector.alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("node", F.when(F.coalesce(fine, F.lit(False)), F.xxhash64("vector")))
    valid = rows.filter("node is not null")
    classes = _classes(valid)

    for attempt in range(attempts):
        k = neighbours << attempt
        found, counted, crowded = _descent(classes, least, k, orders << attempt, most_rounds)
        if _audited(classes, counted, crowded, least, probes) >= recall:
            break
    else:
        found, counted = _compared(classes, found, least)
    named = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    of_class = stored(
        named.join(smallest, "component").join(counted, "node", "left").select("node", "component_id", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links")),
        "vector-components",
    )
    alone = rows.filter("node is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return (
        valid.select("id", "node").join(of_class, "node").select("id", "n_links", "component_id").union(alone)
        .select(F.col("id").alias(id_col), "n_links", F.col("component_id"), F.col("component_id").eqNullSafe(F.col("id")).alias("kept"))
    )


def _descent(classes: DataFrame, least: float, k: int, orders: int, most_rounds: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Components (``node``, ``component``) and link counts (``node``, ``linked``) of the linked classes, and the ``node`` of those in crowded components."""
    lists = stored(_best(_ordered(classes, orders, k), k), "neighbours")
    near = F.size(F.filter("near", lambda e: e["away"] <= SLACK - least))

    def edges(lists: DataFrame) -> int:
        return lists.agg(F.coalesce(F.sum(near), F.lit(0))).first()[0]

    before = edges(lists)
    for _ in range(most_rounds):
        lists = stored(_best(_local_joins(lists, classes, k).union(lists), k), "neighbours")
        now = edges(lists)
        if now <= before * 1.001:
            break
        before = now
    close = lists.select(F.col("node").alias("a"), F.explode("near").alias("entry")).filter(F.col("entry.away") <= SLACK - least)
    pairs = close.select(F.least("a", "entry.id").alias("a"), F.greatest("a", "entry.id").alias("b")).distinct()
    links = stored(_linked(pairs, classes, least), "links")
    found = components(links)
    crowded = _crowded(lists, found, classes, near >= k)
    across = stored(_linked_across(crowded, least), "links-across")
    if not across.isEmpty():
        links = stored(links.union(across), "links")
        found = components(links)
        crowded = _crowded(lists, found, classes, near >= k)
    blocks = _counted_in_blocks(crowded, least)
    ends = links.union(links.select("b", "a")).toDF("node", "other").join(crowded.select("node"), "node", "left_anti")
    listed = ends.join(classes.select(F.col("node").alias("other"), "copies"), "other").groupBy("node").agg(F.sum("copies").alias("linked"))
    return found, stored(blocks.union(listed), "link-counts"), crowded


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding with its links and its component."""
    return near_vectors(table(spark, sf_dir, "embeddings"))
