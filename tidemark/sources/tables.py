"""Catalog tables: listing, batch scans and streaming scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.audit import add_audit


def qualified_name(*parts: str | None) -> str:
    """``catalog.schema.table`` from its parts; absent parts are left out."""
    given = [p for p in parts if p]
    if not given:
        raise ValueError("a table name needs at least one part")
    return ".".join(f"`{p}`" for p in given)


def list_tables(spark: SparkSession, database: str, exclude_type: str | None = "MANAGED") -> DataFrame:
    """Tables of a database as rows ``(table_name, table_type)``, without those of one type."""
    found = [
        (t.name, t.tableType) for t in spark.catalog.listTables(database) if not t.isTemporary
    ]
    tables = spark.createDataFrame(found, "table_name string, table_type string")
    if exclude_type:
        tables = tables.filter(F.col("table_type") != exclude_type)
    return tables.distinct()


def read_table(spark: SparkSession, name: str, audit_source: str | None = None) -> DataFrame:
    df = spark.read.table(name)
    return add_audit(df, audit_source) if audit_source else df


def table_stream(spark: SparkSession, name: str, audit_source: str | None = None) -> DataFrame:
    df = spark.readStream.table(name)
    return add_audit(df, audit_source) if audit_source else df
