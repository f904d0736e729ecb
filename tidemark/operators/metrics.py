"""A metric view: one fact, its dimensions' columns and named measures.

A query names labels and measures; the view builds one star-join/aggregate plan
that touches only the joins those labels need. Joins are many-to-one from the
fact (left, so a missed lookup keeps its row), which is why an unused one can be
left out; ``repeated_join_keys`` shows rows that break this.

When a query needs a single dimension table, the fact is aggregated by that
table's key *before* the join. If the join has to shuffle, partial sums travel
instead of fact rows and a hot key shrinks to one row per task; the shuffle of
the aggregation is the one the join needs.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.surrogate import duplicate_keys

MEASURE_KINDS = ("sum", "avg", "count", "min", "max", "count_distinct")


@dataclass(frozen=True)
class Join:
    """A dimension table and the equality of fact columns with its key columns."""

    table: DataFrame
    on: Mapping[str, str]


@dataclass(frozen=True)
class Dimension:
    """A SQL expression over the fact, or over one joined table."""

    expr: str
    join: str | None = None


@dataclass(frozen=True)
class Measure:
    """An aggregate of a SQL expression over the fact, evaluated at the query's grouping."""

    kind: str
    expr: str

    def __post_init__(self) -> None:
        if self.kind not in MEASURE_KINDS:
            raise ValueError(f"measure kind must be one of {MEASURE_KINDS}, not {self.kind!r}")

    def partials(self, value: Column) -> dict[str, Column]:
        if self.kind == "avg":
            return {"s": F.sum(value), "n": F.count(value)}
        if self.kind == "count_distinct":
            return {}
        return {"v": getattr(F, self.kind)(value)}

    def merge(self, part) -> dict[str, Column]:
        """Partials of a coarser grouping from those of a finer one."""
        if self.kind in ("min", "max"):
            return {"v": getattr(F, self.kind)(part("v"))}
        return {p: F.sum(part(p)) for p in (("s", "n") if self.kind == "avg" else ("v",))}

    def combine(self, part) -> Column:
        """The measure from partial results; ``part(name)`` is a partial's column."""
        if self.kind == "avg":
            return _ratio(F.sum(part("s")), F.sum(part("n")))
        if self.kind in ("sum", "count"):
            total = F.sum(part("v"))
            return F.coalesce(total, F.lit(0)) if self.kind == "count" else total
        return getattr(F, self.kind)(part("v"))

    def direct(self, value: Column) -> Column:
        if self.kind == "avg":
            return _ratio(F.sum(value), F.count(value))
        return getattr(F, self.kind)(value)


def _ratio(total: Column, rows: Column) -> Column:
    return F.try_divide(total.cast("double"), rows)


class MetricView:
    """``dimensions`` map labels to ``"column"``, ``"join.column"`` or a ``Dimension``."""

    def __init__(
        self,
        source: DataFrame,
        joins: Mapping[str, Join],
        dimensions: Mapping[str, str | Dimension],
        measures: Mapping[str, Measure],
    ) -> None:
        self.source = source
        self.joins = dict(joins)
        self.dimensions = {label: self._dimension(d) for label, d in dimensions.items()}
        self.measures = dict(measures)
        for label, dim in self.dimensions.items():
            if dim.join is not None and dim.join not in self.joins:
                raise ValueError(f"dimension {label!r} uses unknown join {dim.join!r}")
        clash = set(self.dimensions) & set(self.measures)
        if clash:
            raise ValueError(f"labels used for a dimension and a measure: {sorted(clash)}")

    def _dimension(self, given: str | Dimension) -> Dimension:
        if isinstance(given, Dimension):
            return given
        qualified = re.fullmatch(r"(\w+)\.(\w+)", given)
        if qualified and qualified[1] in self.joins:
            return Dimension(qualified[2], qualified[1])
        return Dimension(given)

    def repeated_join_keys(self) -> dict[str, DataFrame]:
        """Per join, key values on more than one row; each should be empty."""
        return {n: duplicate_keys(j.table, list(j.on.values())) for n, j in self.joins.items()}

    # -- queries ---------------------------------------------------------------

    def query(
        self,
        dimensions: Sequence[str] = (),
        measures: Sequence[str] = (),
        extra: Mapping[str, tuple[str, str]] | None = None,
        filters: Mapping[str, Any] | None = None,
        grouping_sets: Sequence[Sequence[str]] | None = None,
        total_flags: bool = False,
        order_by: Sequence[str | tuple[str, str]] = (),
        pre_aggregate: bool | None = None,
    ) -> DataFrame:
        """Measures by dimensions, as one DataFrame.

        ``extra`` adds aggregates over dimension labels, ``{name: (kind, label)}``,
        e.g. a distinct count. ``filters`` keep rows whose label equals the value
        (or is in the list, or is null for ``None``). ``grouping_sets`` lists label
        subsets, ``[]`` being the grand total; ``total_flags`` then adds
        ``<label>_is_total`` to tell a total from a null label.
        """
        aggregates = {name: self._measure(name) for name in measures}
        extras = {name: (Measure(kind, label), label) for name, (kind, label) in (extra or {}).items()}
        if not aggregates and not extras:
            raise ValueError("a query needs a measure or an extra aggregate")
        filters = dict(filters or {})
        used = list(dict.fromkeys([*dimensions, *filters, *[lb for _, lb in extras.values()]]))

        frame, reduced = self._star(used, aggregates, extras, filters, pre_aggregate)
        grouped = self._grouped(frame, dimensions, grouping_sets)
        results = [
            (m.combine(lambda p, n=name: F.col(f"_p_{n}_{p}")) if reduced else m.direct(F.col(f"_m_{name}"))).alias(name)
            for name, m in aggregates.items()
        ]
        for name, (m, label) in extras.items():
            if reduced and m.kind == "count":
                value = F.coalesce(
                    F.sum(F.when(F.col(_d(label)).isNotNull(), F.col("_rows"))), F.lit(0)
                )
            else:
                value = m.direct(F.col(_d(label)))
            results.append(value.alias(name))
        flags = []
        if total_flags and grouping_sets is not None:
            flags = [F.grouping(_d(lb)).cast("int").alias(f"{lb}_is_total") for lb in dimensions]
        result = grouped.agg(*results, *flags)
        out = result.select(
            *[F.col(_d(lb)).alias(lb) for lb in dimensions],
            *aggregates,
            *extras,
            *[f"{lb}_is_total" for lb in dimensions if flags],
        )
        return out.orderBy(*[_ordering(o) for o in order_by]) if order_by else out

    def filter_values(
        self, label: str, filters: Mapping[str, Any] | None = None, count_name: str = "rows"
    ) -> DataFrame:
        """Each value of a filter field with the rows that pass all *other* filters."""
        others = {lb: v for lb, v in (filters or {}).items() if lb != label}
        used = list(dict.fromkeys([label, *others]))
        frame, reduced = self._star(used, {}, {}, {}, None)
        passes = F.lit(True)
        for lb, value in others.items():
            passes = passes & F.coalesce(_matches(F.col(_d(lb)), value), F.lit(False))
        if reduced:
            surviving = F.coalesce(F.sum(F.when(passes, F.col("_rows"))), F.lit(0))
        else:
            surviving = F.count_if(passes)
        return (
            frame.groupBy(_d(label))
            .agg(surviving.alias(count_name))
            .select(F.col(_d(label)).alias(label), count_name)
        )

    # -- partial results, to be stored -------------------------------------------

    def partials(self, labels: Sequence[str], measures: Sequence[str]) -> DataFrame:
        """Rows and partial measures by labels, under the names that ``Measure.combine`` is given."""
        aggregates = {name: self._measure(name) for name in measures}
        unfit = [name for name, m in aggregates.items() if m.kind == "count_distinct"]
        if unfit:
            raise ValueError(f"distinct counts have no partial results: {unfit}; count a label by words")
        frame, reduced = self._star(list(labels), aggregates, {}, {}, None)
        if reduced:
            return merge_partials(frame, labels, aggregates)
        parts = [
            agg.alias(f"_p_{name}_{p}")
            for name, m in aggregates.items()
            for p, agg in m.partials(F.col(f"_m_{name}")).items()
        ]
        return frame.groupBy(*[_d(lb) for lb in labels]).agg(F.count(F.lit(1)).alias("_rows"), *parts)

    def label_values(self, labels: Sequence[str]) -> DataFrame:
        """The labels of the fact's rows, reduced to fewer rows where that is cheap."""
        frame, _ = self._star(list(labels), {}, {}, {}, None)
        return frame.select(*[_d(lb) for lb in labels])

    # -- plan building ---------------------------------------------------------

    def _measure(self, name: str) -> Measure:
        if name not in self.measures:
            raise ValueError(f"no measure {name!r}; there are {sorted(self.measures)}")
        return self.measures[name]

    def _label(self, label: str) -> Dimension:
        if label not in self.dimensions:
            raise ValueError(f"no dimension {label!r}; there are {sorted(self.dimensions)}")
        return self.dimensions[label]

    def _star(self, labels, aggregates, extras, filters, pre_aggregate) -> tuple[DataFrame, bool]:
        """Fact columns, reduced if worthwhile, with the needed joins and filters."""
        by_join: dict[str, list[str]] = {}
        own: list[str] = []
        for label in labels:
            dim = self._label(label)
            (own if dim.join is None else by_join.setdefault(dim.join, [])).append(label)

        frame = self.source.select(
            *[
                F.col(c).alias(_k(name, i))
                for name in by_join
                for i, c in enumerate(self.joins[name].on)
            ],
            *[F.expr(self.dimensions[lb].expr).alias(_d(lb)) for lb in own],
            *[F.expr(m.expr).alias(f"_m_{name}") for name, m in aggregates.items()],
        )
        for label in own:
            if label in filters:
                frame = frame.filter(_matches(F.col(_d(label)), filters[label]))

        distinct_measure = any(m.kind == "count_distinct" for m in aggregates.values())
        row_counting = all(
            m.kind in ("count", "count_distinct", "min", "max") for m, _ in extras.values()
        )
        can_reduce = not distinct_measure and row_counting
        if pre_aggregate is None:
            pre_aggregate = can_reduce and len(by_join) == 1
        if pre_aggregate and not can_reduce:
            raise ValueError("these aggregates cannot be computed from partial results")
        if pre_aggregate:
            keys = [_k(name, i) for name in by_join for i in range(len(self.joins[name].on))]
            partials = [
                agg.alias(f"_p_{name}_{p}")
                for name, m in aggregates.items()
                for p, agg in m.partials(F.col(f"_m_{name}")).items()
            ]
            frame = frame.groupBy(*keys, *[_d(lb) for lb in own]).agg(
                F.count(F.lit(1)).alias("_rows"), *partials
            )

        for name, used in by_join.items():
            frame = self._joined(frame, name, used)
            for label in used:
                if label in filters:
                    frame = frame.filter(_matches(F.col(_d(label)), filters[label]))
        return frame, bool(pre_aggregate)

    def _joined(self, frame: DataFrame, name: str, labels: list[str]) -> DataFrame:
        join = self.joins[name]
        slim = join.table.select(
            *[F.col(c).alias(f"_j{i}") for i, c in enumerate(join.on.values())],
            *[F.expr(self.dimensions[lb].expr).alias(_d(lb)) for lb in labels],
        )
        condition = F.lit(True)
        for i in range(len(join.on)):
            condition = condition & (F.col(_k(name, i)) == F.col(f"_j{i}"))
        return frame.join(slim, condition, "left").drop(*[f"_j{i}" for i in range(len(join.on))])

    def _grouped(self, frame: DataFrame, dimensions, grouping_sets):
        if grouping_sets is None:
            return frame.groupBy(*[_d(lb) for lb in dimensions])
        extra = {lb for s in grouping_sets for lb in s} - set(dimensions)
        if extra:
            raise ValueError(f"grouping sets name labels that are not queried: {sorted(extra)}")
        return frame.groupingSets(
            [[F.col(_d(lb)) for lb in s] for s in grouping_sets],
            *[F.col(_d(lb)) for lb in dimensions],
        )


def merge_partials(
    frame: DataFrame, labels: Sequence[str], aggregates: Mapping[str, Measure]
) -> DataFrame:
    """Partial results brought to fewer labels."""
    parts = [
        agg.alias(f"_p_{name}_{p}")
        for name, m in aggregates.items()
        for p, agg in m.merge(lambda p, n=name: F.col(f"_p_{n}_{p}")).items()
    ]
    return frame.groupBy(*[_d(lb) for lb in labels]).agg(F.sum("_rows").alias("_rows"), *parts)


def _d(label: str) -> str:
    return f"_d_{label}"


def _k(join: str, position: int) -> str:
    return f"_k_{join}_{position}"


def _matches(column: Column, value: Any) -> Column:
    if value is None:
        return column.isNull()
    if isinstance(value, (list, tuple, set)):
        return column.isin(list(value))
    return column == F.lit(value)


def _ordering(order: str | tuple[str, str]) -> Column:
    name, direction = (order, "asc") if isinstance(order, str) else order
    if direction not in ("asc", "desc"):
        raise ValueError("order direction must be 'asc' or 'desc'")
    return F.col(name).asc() if direction == "asc" else F.col(name).desc()
