"""One entry for all kinds of source, chosen by the load type."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.sources.files import file_stream
from tidemark.sources.tables import read_table, table_stream

# The load types a table definition can name.
LOAD_TYPES = ("table", "table_stream", "volume", "dataframe")


@dataclass(frozen=True)
class LoadSpec:
    """Where a table comes from.

    ``table``: batch scan of ``name``. ``table_stream``: stream of ``name``, with
    audit column. ``volume``: stream of the files in ``path``, with audit column;
    without ``schema`` the files are read once to infer it. ``dataframe``: the given
    frame as it is.
    """

    loadtype: str = "dataframe"
    name: str | None = None
    path: str | None = None
    filetype: str | None = None
    dataframe: DataFrame | None = None
    source_system: str = "landing"
    schema: T.StructType | None = None
    schema_location: str | None = None
    max_files_per_trigger: int | None = None

    def __post_init__(self) -> None:
        if self.loadtype not in LOAD_TYPES:
            raise ValueError(f"loadtype must be one of {LOAD_TYPES}, not {self.loadtype!r}")
        needs = {
            "table": ["name"],
            "table_stream": ["name"],
            "volume": ["path", "filetype"],
            "dataframe": ["dataframe"],
        }[self.loadtype]
        missing = [n for n in needs if getattr(self, n) is None]
        if missing:
            raise ValueError(f"loadtype {self.loadtype!r} needs {missing}")


def load(spark: SparkSession, spec: LoadSpec) -> DataFrame:
    if spec.loadtype == "table":
        return read_table(spark, spec.name)
    if spec.loadtype == "table_stream":
        return table_stream(spark, spec.name, spec.source_system)
    if spec.loadtype == "volume":
        return file_stream(
            spark,
            spec.path,
            spec.filetype,
            schema=spec.schema,
            schema_location=spec.schema_location,
            audit_source=spec.source_system,
            max_files_per_trigger=spec.max_files_per_trigger,
        )
    return spec.dataframe
