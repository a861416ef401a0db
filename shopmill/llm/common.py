"""Small helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word contract, as a regular expression class and as characters to trim.
SPACE = r"[\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\x0c\r"


def show_package(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package; on other machines install or ship it."""
    home = str(Path(__file__).resolve().parents[2])
    own = spark.sparkContext.environment
    if home not in own.get("PYTHONPATH", "").split(":"):
        own["PYTHONPATH"] = f"{own['PYTHONPATH']}:{home}" if own.get("PYTHONPATH") else home


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once per row, however often ``then`` uses it.

    A plain column would be pasted into every use by the optimizer, inside a lambda once per element.
    """
    return F.element_at(F.transform(F.array(value), then), 1)


def text_of(column: str) -> Column:
    """The column as text, NULL as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Maximal runs without white space, in order; an empty array for a blank text."""
    return let(
        F.btrim(text, F.lit(BLANKS)),
        lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(
            F.split(t, f"{SPACE}+")
        ),
    )


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as make it no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
