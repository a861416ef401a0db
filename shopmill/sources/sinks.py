"""Writers: Parquet tables, SQL views, JSON event documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shopmill import schemas

IDS_PER_FOLDER = 1_000_000
SHELF_BITS = 7  # leading bits of a range's number that tell its folder from others


def shelf(bucket: Column) -> Column:
    """The folder that holds a range of order ids, by the number of the last range it holds.

    Ranges below 128 have folders of their own; beyond, neighbours that agree in the seven leading bits of their numbers share
    one. So there are at most 64 folders for every doubling of the ids, however narrow the ranges are, and the
    folder of an id is the same in every batch. A folder's number is never below that of a range in it, so "folder >= range"
    drops no row that "range >= range" keeps.
    """
    spare = F.greatest(F.length(F.bin(bucket)) - F.lit(SHELF_BITS), F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", bucket, spare) + F.lit(1), spare) - F.lit(1)


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite", compression: str = "snappy"
) -> None:
    """Parquet, with snappy unless told otherwise. Partitioned output is rebalanced by its partition columns first, so
    that small folders get one file and large ones several of even size (adaptive execution).
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).option("compression", compression)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    write_table(df, path, partition_by, mode="append")


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame | str]) -> None:
    """Expose tables to SQL by name: DataFrames, or paths of written Parquet tables."""
    for name, table in tables.items():
        df = spark.read.parquet(table) if isinstance(table, str) else table
        df.createOrReplaceTempView(name)


def register_tables(
    spark: SparkSession,
    tables: Mapping[str, str],
    database: str = "shop",
    partition_by: Mapping[str, Sequence[str]] | None = None,
    analyze: bool = True,
) -> None:
    """Written Parquet tables as tables of Spark's catalog, by name and path, with statistics.

    Tables point to their folders and are made anew, so they follow a changed schema; dropping one leaves its files. For
    tables in ``partition_by`` the catalog is told the partitions that the folder has. ``analyze`` counts rows, sizes and the
    columns' values, from which the optimizer picks join orders and broadcasts (``spark.sql.cbo.enabled``).
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, path in tables.items():
        full = f"`{database}`.`{name}`"
        folders = list((partition_by or {}).get(name, ()))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        by = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in folders)})" if folders else ""
        place = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {full} ({columns}) USING parquet {by} LOCATION '{place}'")
        if folders:
            spark.sql(f"ALTER TABLE {full} RECOVER PARTITIONS")
        if analyze:
            spark.sql(f"ANALYZE TABLE {full} COMPUTE STATISTICS FOR ALL COLUMNS")


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> DataFrame:
    """A table of the catalog whose files hold the rows of a key's hash, sorted by key: joins and groupings by
    the key need no shuffle of it. Returns the table."""
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    writer.mode("overwrite").option("path", path).format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)


def write_observed(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> dict[str, int]:
    """``write_table``, with the number of rows (``rows``) and of NULLs by column counted by the same job."""
    seen = Observation()
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"c{i}") for i, c in enumerate(df.columns)]
    write_table(df.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls), path, partition_by, mode)
    found = seen.get
    return {"rows": found["rows"]} | {c: found[f"c{i}"] for i, c in enumerate(df.columns)}


def event_text() -> Column:
    """An event's columns as JSON text."""
    return F.to_json(F.struct(*schemas.schema("event").fieldNames()), {"ignoreNullFields": "false"})


def write_events(events: DataFrame, path: str, ids_per_folder: int = IDS_PER_FOLDER, dealt: bool = False) -> None:
    """Events as JSON lines in folders of consecutive order ids (``shelf``), so that a pull can prune; gzipped, as they repeat
    every key in every line. A file is one task's to read, and the rebalancing keeps files small.

    ``dealt`` says that near ids lie together already, so that no row is moved; rows are put in order typed, as texts are longer.
    """
    fields = schemas.schema("event").fieldNames()
    bucket = F.floor(F.col("order.OrderID") / F.lit(ids_per_folder)).cast("long")
    rows = events.select(*fields, shelf(bucket).alias("id_bucket"))
    rows = rows.sortWithinPartitions("id_bucket") if dealt else rows.hint("rebalance", "id_bucket")
    lines = rows.select(event_text().alias("value"), "id_bucket")
    lines.write.mode("overwrite").partitionBy("id_bucket").option("compression", "gzip").text(path)


def write_texts(texts: DataFrame, path: str, mode: str = "error") -> None:
    """One column of texts as gzipped lines."""
    texts.write.mode(mode).option("compression", "gzip").text(path)
