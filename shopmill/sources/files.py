"""Readers: headered CSV, JSON order events, raw documents, listings, bounded pulls."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopmill import schemas
from shopmill.operators.scale import durable

MAX_PULL = 1000


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    multiline: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Headered CSV with declared types; the header must name the schema's columns in order.

    A field that does not parse is NULL, or an error with ``strict``. ``multiline`` admits line
    breaks inside quotes and costs splitting of the file, so ask for it only where needed.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", multiline)
        .option("mode", "FAILFAST" if strict else "PERMISSIVE")
        .csv(path)
    )


def read_entity(spark: SparkSession, root: str, name: str, **options) -> DataFrame:
    """One raw entity ``<root>/<name>.csv`` with its declared schema."""
    return read_csv(spark, f"{root}/{name}.csv", schemas.schema(name), **options)


def read_events(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Order events, one document per file, or JSON lines with ``multiline=False``."""
    return spark.read.schema(schemas.schema("event")).option("multiLine", multiline).json(path)


REJECTED = "_corrupt"


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType | str, multiline: bool = False) -> DataFrame:
    """``read_csv`` with two more columns: ``_file``, and ``_corrupt``, the raw record where it has too few or
    too many fields or one that does not parse, else NULL."""
    columns = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = (
        spark.read.schema(T.StructType([*columns.fields, T.StructField(REJECTED, T.StringType())]))
        .option("header", True)
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECTED)
        .csv(path)
    )
    return rows.select("*", F.col("_metadata.file_path").alias("_file"))


def read_events_checked(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """Typed events with ``_file``, and ``_corrupt``, the raw text where it is no JSON object of the event's
    types (a blank one as well; Spark lists no file of zero bytes). One document per file, or JSON lines with ``whole_files=False``."""
    texts = spark.read.text(path, wholetext=whole_files)
    texts = texts.select("value", F.col("_metadata.file_path").alias("_file"))
    fields = T.StructType([*schemas.schema("event").fields, T.StructField(REJECTED, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED}
    parsed = texts.select("value", "_file", F.from_json("value", fields, options).alias("e"))
    blank = F.trim("value") == ""
    array = F.ltrim("value").startswith("[")
    bad = F.col("e").isNull() | F.col(f"e.{REJECTED}").isNotNull() | blank | array
    names = schemas.schema("event").fieldNames()
    return parsed.select(*[F.col(f"e.{n}").alias(n) for n in names], F.when(bad, F.col("value")).alias(REJECTED), "_file")


def split_rejects(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sound rows, rejects ``file, record``) of a checked read, which is written once so that it is parsed once."""
    rows = durable(checked)
    bad = F.col(REJECTED).isNotNull()
    rejects = rows.filter(bad).select(F.col("_file").alias("file"), F.col(REJECTED).alias("record"))
    return rows.filter(~bad).drop(REJECTED, "_file"), rejects


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Each file's whole text in ``value``, unparsed, for validation before typing."""
    return spark.read.text(path, wholetext=True)


def parse_events(documents: DataFrame, column: str = "value") -> DataFrame:
    """Typed events from raw JSON text."""
    return documents.select(F.from_json(column, schemas.schema("event")).alias("e")).select("e.*")


def list_inputs(df: DataFrame) -> DataFrame:
    """Input files behind a file-backed DataFrame, with size in bytes."""
    meta = df.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")
    )
    return meta.distinct()


def read_events_since(
    spark: SparkSession, path: str, from_id: int, limit: int, ids_per_folder: int = 1_000_000
) -> DataFrame:
    """Landed events (JSON lines in ``id_bucket`` folders) of the ``limit`` lowest ids >= ``from_id``.

    Folders of lower ids are pruned before any document is parsed, and so are those behind the last one needed: folders
    hold disjoint ranges of ids in the order of their numbers, so they are gone through, more at each step, until the ids are found.
    """
    _check_pull(from_id, limit)
    texts = spark.read.schema("value string, id_bucket long").text(path)
    named = [re.search(r"/id_bucket=(-?\d+)/", f) for f in texts.inputFiles()]
    texts = texts.filter(F.col("id_bucket") >= from_id // ids_per_folder)
    ahead = sorted({int(m[1]) for m in named if m and int(m[1]) >= from_id // ids_per_folder})
    found = at = 0
    while found < limit and at < len(ahead):
        step = ahead[at : 2 * at + 1]
        looked = parse_events(texts.filter(F.col("id_bucket").between(step[0], step[-1])))
        ids = looked.select(F.col("order.OrderID").alias("orderid")).filter(F.col("orderid") >= from_id)
        found += ids.distinct().limit(limit).count()
        at += len(step)
    if at < len(ahead):
        texts = texts.filter(F.col("id_bucket") <= ahead[at - 1])
    events = parse_events(texts).withColumn("orderid", F.col("order.OrderID"))
    return read_since(events, from_id, limit).drop("orderid")


def _check_pull(from_id: int, limit: int) -> None:
    if from_id < 1:
        raise ValueError("from_id must be greater than 0")
    if not 1 <= limit <= MAX_PULL:
        raise ValueError(f"limit must be between 1 and {MAX_PULL}")


def read_since(df: DataFrame, from_id: int, limit: int, id_col: str = "orderid") -> DataFrame:
    """All events of the ``limit`` lowest ids >= ``from_id``, lowest ids first.

    An id is taken with every event it has, so a pull may hold more than ``limit`` rows and the next one, from the last id
    plus one, misses none. Rows of one id come in no certain order.
    """
    _check_pull(from_id, limit)
    wanted = df.filter(F.col(id_col) >= from_id)
    ids = wanted.select(id_col).distinct().orderBy(id_col).limit(limit)  # at most MAX_PULL numbers
    return wanted.join(F.broadcast(ids), id_col, "left_semi").orderBy(id_col)


def next_id(batch: DataFrame, from_id: int, id_col: str = "orderid") -> DataFrame:
    """One row: where the next pull starts (unchanged when the batch is empty)."""
    return batch.agg(F.coalesce(F.max(id_col) + 1, F.lit(from_id)).cast("long").alias("next_id"))


def get_event(df: DataFrame, event_id: int, id_col: str = "orderid") -> DataFrame:
    return df.filter(F.col(id_col) == event_id)
