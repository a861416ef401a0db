"""Merge historical and incoming records into one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmill.functions.cleaning import dedup
from shopmill.operators.scale import skew_join


def unify(
    historical: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    latest: Sequence[Column] = (),
    keep_null_keys: bool = False,
    historical_is_unique: bool = False,
) -> DataFrame:
    """Union by name, then one row per key: incoming beats historical, then ``latest``.

    Types must agree; a silent widening of money to double is refused. With
    ``historical_is_unique`` (one key column) the stored side is not re-deduplicated: only its
    replaced keys are removed, which needs no shuffle of it when the incoming batch is small.
    """
    for name in columns:
        old, new = historical.schema[name].dataType, incoming.schema[name].dataType
        if old != new:
            raise TypeError(f"{name}: historical {old.simpleString()}, incoming {new.simpleString()}")
    if not keep_null_keys:
        historical, incoming = historical.dropna(subset=list(keys)), incoming.dropna(subset=list(keys))
    if historical_is_unique and len(keys) == 1 and not keep_null_keys:
        replaced = incoming.select(*keys).distinct()
        kept = skew_join(historical.select(*columns), replaced, keys[0], "left_anti", "right")
        return kept.unionByName(dedup(incoming, keys, latest).select(*columns))

    extra = sorted({c for c in incoming.columns if c not in columns} if latest else set())
    old = historical.select(*columns).withColumn("_source", F.lit(1))
    new = incoming.select(*columns, *extra).withColumn("_source", F.lit(0))
    merged = old.unionByName(new, allowMissingColumns=bool(extra))
    return dedup(merged, keys, [F.col("_source"), *latest]).select(*columns)
