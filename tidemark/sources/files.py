"""Landing folders: what lies there, batch reads and incremental file streams."""

from __future__ import annotations

import json
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.audit import add_audit
from tidemark.workspace import is_file, path_exists, publish, qualified_path, staging_folder

FORMATS = ("parquet", "json", "csv", "orc")
CORRUPT_RECORD = "_corrupt_record"
SOURCE_FILE = "_source_file"
NEW_COLUMNS = "new columns in landed files"

# JSON values are read as text, so that a later file cannot change a column's type.
READ_OPTIONS = {
    "json": {"primitivesAsString": "true", "columnNameOfCorruptRecord": CORRUPT_RECORD},
    "csv": {"header": "true"},
}


def discover(spark: SparkSession, root: str) -> DataFrame:
    """Datasets below a landing folder as rows ``(dataset, format)``.

    A dataset is a folder of files or one file directly below ``root``. Only paths
    are listed (Spark lists large folders in parallel), no file is opened. Files of a
    kind that cannot be read are listed under their suffix, or ``unknown`` without
    one, so that whoever ingests them fails and loses nothing. A missing root is an
    error, not an empty result.
    """
    _check_root(spark, root)
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path")
    )
    prefix = qualified_path(spark, root)
    below = F.substring(F.col("path"), F.lit(len(prefix) + 2), F.length("path"))
    leaf = F.regexp_replace(F.substring_index("path", "/", -1), r"\.(gz|bz2|zst|lz4|snappy)$", "")
    return (
        listing.select(
            F.regexp_extract(below, r"^([^/]+?)(\.\w+)?(/|$)", 1).alias("dataset"),
            F.coalesce(
                F.nullif(F.lower(F.regexp_extract(leaf, r"\.(\w+)$", 1)), F.lit("")), F.lit("unknown")
            ).alias("format"),
        )
        .distinct()
    )


def _check_root(spark: SparkSession, root: str) -> None:
    if not path_exists(spark, root):
        raise FileNotFoundError(f"no landing folder {root}")


def _check_format(file_format: str) -> None:
    if file_format not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {file_format!r}")


def infer_schema(spark: SparkSession, path: str | list[str], file_format: str, modified_after: str | None = None) -> T.StructType:
    """Schema of the files now in ``path`` (of those changed later, if asked for); every column nullable."""
    _check_format(file_format)
    reader = _reader(spark.read, file_format)
    if file_format in ("parquet", "orc"):
        reader = reader.option("mergeSchema", "true")
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after).option("timeZone", "UTC")
    schema = reader.load(path).schema
    if file_format == "json" and CORRUPT_RECORD not in schema.fieldNames():
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT_RECORD, T.StringType())])
    return schema


def _reader(reader, file_format: str):
    return reader.format(file_format).options(**READ_OPTIONS.get(file_format, {}))


def read_files(
    spark: SparkSession, path: str, file_format: str, schema: T.StructType | None = None
) -> DataFrame:
    _check_format(file_format)
    reader = _reader(spark.read, file_format)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def remembered_schema(
    spark: SparkSession, path: str, file_format: str, schema_location: str
) -> T.StructType:
    """The columns of all starts so far, in order of appearance.

    Each start opens the files only that came since the last one; their new columns are
    added behind the known ones. A column that comes with another type is an error.
    """
    known, until = recalled_schema(spark, schema_location)
    newest = _newest(spark, path, until)
    if known is not None and newest is None:
        return known
    schema = infer_schema(spark, path, file_format, until)
    if known is not None:
        schema = evolved(known, schema)
    remember_schema(spark, schema_location, schema, newest)
    return schema


def recalled_schema(spark: SparkSession, schema_location: str) -> tuple[T.StructType | None, str | None]:
    """The remembered columns, and the time up to which files have been looked at; None where there is none."""
    if not path_exists(spark, f"{schema_location}/_SUCCESS"):
        return None, None
    found = json.loads(spark.read.text(schema_location, wholetext=True).first()[0])
    return T.StructType.fromJson(found), found.get("until")


def remember_schema(spark: SparkSession, schema_location: str, schema: T.StructType, until: str | None) -> None:
    text = json.dumps({**schema.jsonValue(), "until": until})
    staged = staging_folder(schema_location)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(staged)
    publish(spark, staged, schema_location)


def _newest(spark: SparkSession, path: str, after: str | None) -> str | None:
    """When the newest file came that is not looked at yet, less two seconds, as file times are coarse; files are only listed."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("timeZone", "UTC")
    if after:
        reader = reader.option("modifiedAfter", after)
    at = F.max(F.col("modificationTime") - F.expr("interval 2 seconds"))
    return reader.load(path).agg(F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss")).first()[0]


class NewColumns(ValueError):
    """Files of a micro-batch hold columns that their stream does not know."""


def guarded(write: Callable[[DataFrame, int], None], file_format: str, schema: T.StructType, schema_location: str) -> Callable[[DataFrame, int], None]:
    """``write`` for micro-batches of a ``file_stream`` with ``name_files``, behind a look at the schema of their files.

    If they hold columns that the stream's ``schema`` lacks, the columns are remembered
    and the batch fails before anything of it is written or its offset is committed: the
    next start reads the same files with all their columns. A column of another type
    fails, too. Only the batch's own files are opened.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        files = [unquote(r[0]) for r in batch.select(SOURCE_FILE).distinct().collect()]
        if files:
            wider = evolved(schema, infer_schema(spark, files, file_format))
            if wider != schema:
                known, until = recalled_schema(spark, schema_location)
                remember_schema(spark, schema_location, evolved(known, wider) if known else wider, until)
                raise NewColumns(f"{NEW_COLUMNS}: {sorted(set(wider.fieldNames()) - set(schema.fieldNames()))}")
        write(batch.drop(SOURCE_FILE), batch_id)

    return run


def evolved(known: T.StructType, found: T.StructType) -> T.StructType:
    """``known`` with the new columns of ``found``; a changed type is refused by name."""
    types = {f.name: f.dataType for f in known.fields}
    changed = [f.name for f in found.fields if f.name in types and f.dataType != types[f.name]]
    if changed:
        raise ValueError(f"columns with another type than before: {changed}")
    return T.StructType([*known.fields, *[f for f in found.fields if f.name not in types]])


def file_stream(
    spark: SparkSession,
    path: str,
    file_format: str,
    schema: T.StructType | None = None,
    schema_location: str | None = None,
    audit_source: str | None = None,
    max_files_per_trigger: int | None = None,
    name_files: bool = False,
) -> DataFrame:
    """Each file of a folder once, as a stream; progress is kept by the query's checkpoint.

    Without ``schema`` it is inferred by a batch read of all files there; with
    ``schema_location`` the columns of earlier starts stay and only new files are
    looked at. ``audit_source`` appends the audit struct, ``name_files`` the file of each
    row, for ``guarded``.
    """
    _check_format(file_format)
    if schema is None:
        _check_root(spark, path)
        schema = (
            remembered_schema(spark, path, file_format, schema_location)
            if schema_location
            else infer_schema(spark, path, file_format)
        )
    reader = _reader(spark.readStream, file_format).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # A stream takes folders or patterns; a single file is given as a pattern for itself.
    target = f"{path[:-1]}[{path[-1]}]" if is_file(spark, path) else path
    stream = reader.load(target)
    if name_files:
        stream = stream.withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
    return add_audit(stream, audit_source) if audit_source else stream
