"""Sets of integer keys as bits: references are checked exactly, in one pass over the child.

A set has one row for each 64 neighbouring keys and one bit for each key, so dense surrogate keys need two bits a
key where a list of them needs eight bytes. It is written once, which gives Spark its size: a set below the
broadcast threshold travels to the child's tasks and no child row is shuffled, a larger one is joined by a shuffle on
the row of the set, one row a key range, whose hot keys adaptive execution splits.

Defined cases: NULL keys are in no set; repeated keys count once; an empty set holds nothing; negative keys are keys
like any other. Keys that are no integers are refused.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmill.operators.scale import durable

INTEGERS = ("tinyint", "smallint", "int", "bigint")
_WORD, _BITS, _KNOWN = "__word", "__bits", "__known"


def _key(df: DataFrame, key: str) -> Column:
    kind = df.schema[key].dataType.simpleString()
    if kind not in INTEGERS:
        raise ValueError(f"{key} is {kind}, not an integer")
    return F.col(f"`{key}`").cast("long")


def key_set(df: DataFrame, key: str) -> DataFrame:
    """The distinct values of ``key`` as a written set; summed up map side before the shuffle."""
    k = _key(df, key)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), k.bitwiseAND(F.lit(63)).cast("int"))
    words = df.filter(k.isNotNull()).groupBy(F.shiftright(k, 6).alias(_WORD))
    return durable(words.agg(F.bit_or(bit).alias(_BITS)))


def mark_known(df: DataFrame, key: str, keys: DataFrame, out: str) -> DataFrame:
    """``df`` with the boolean ``out``: whether ``key`` is in the set. Never NULL."""
    k = _key(df, key)
    bit = F.getbit(F.col(_BITS), k.bitwiseAND(F.lit(63)).cast("int"))
    joined = df.join(keys, F.shiftright(k, 6) == F.col(_WORD), "left")
    return joined.withColumn(out, F.coalesce(bit == 1, F.lit(False))).drop(_WORD, _BITS)


def without_reference(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in the set, NULL keys included."""
    return mark_known(df, key, keys, _KNOWN).filter(~F.col(_KNOWN)).drop(_KNOWN)


def references(child: DataFrame, sets: Mapping[str, DataFrame], name: str, amount: str | None = None) -> DataFrame:
    """One row a foreign key of ``child``: its rows, those without a parent, the amount an inner join would lose.

    ``sets`` gives the parents' keys by column of the child. However many they are, the child is read once.
    """
    rows = child.select(*sets, *([F.col(amount).alias("__amount")] if amount else []))
    marks = {key: f"{_KNOWN}{i}" for i, key in enumerate(sets)}
    for key, keys in sets.items():
        rows = mark_known(rows, key, keys, marks[key])
    counted = [F.count("*").alias("rows")]
    for mark in marks.values():
        lost = F.sum(F.when(~F.col(mark), F.col("__amount"))) if amount else F.lit(None)
        counted += [F.count_if(~F.col(mark)).alias(f"{mark}n"), lost.cast("decimal(38,2)").alias(f"{mark}a")]
    one = [
        F.struct(
            F.lit(f"{name}.{key}").alias("fk"), "rows",
            F.col(f"{mark}n").alias("unmatched"), F.col(f"{mark}a").alias("lost_amount"),
        )
        for key, mark in marks.items()
    ]
    return rows.agg(*counted).select(F.inline(F.array(*one)))
