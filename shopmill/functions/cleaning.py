"""Cleaning steps, each ``DataFrame -> DataFrame`` in one projection, for ``.transform``."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def clean_name(name: str) -> str:
    return re.sub("[ -]", "_", name.strip().lower())


def clean_columns(df: DataFrame) -> DataFrame:
    """Normalise all column names at once; two names that become equal are an error."""
    names = [clean_name(c) for c in df.columns]
    clash = sorted(n for n, k in Counter(names).items() if k > 1)
    if clash:
        raise ValueError(f"column names collide after cleaning: {clash}")
    return df.toDF(*names)


def _replace(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


def trim_strings(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Trim the named columns, by default every string column."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return _replace(df, {c: F.trim(F.col(c)) for c in (strings if cols is None else cols)})


def normalise_case(df: DataFrame, lower: Iterable[str] = (), upper: Iterable[str] = ()) -> DataFrame:
    """Trim and change case of the named columns."""
    new = {c: F.lower(F.trim(F.col(c))) for c in lower}
    new |= {c: F.upper(F.trim(F.col(c))) for c in upper}
    return _replace(df, new)


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.dropna(how="all")


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str] = ()) -> DataFrame:
    """One row per key, the first in a total order, so the answer is a function of the input.

    ``order_by`` leads; the remaining columns break ties. Spark prunes to one row per key and
    task before the shuffle (WindowGroupLimit), so copies of a hot key never travel together.
    """
    if set(keys) == set(df.columns):
        return df.dropDuplicates(list(keys))
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in set(keys)]
    window = Window.partitionBy(*keys).orderBy(*order_by, *rest)
    return df.withColumn("_nth", F.row_number().over(window)).filter("_nth = 1").drop("_nth")


def cast_columns(df: DataFrame, types: dict[str, str], strict: bool = False) -> DataFrame:
    """Cast by name. A bad value becomes NULL (see ``reject_counts``); ``strict`` raises."""
    return _replace(
        df,
        {c: F.col(c).cast(t) if strict else F.col(c).try_cast(t) for c, t in types.items()},
    )


def cast_ids(
    df: DataFrame, cols: Sequence[str] | None = None, suffix: str = "id", strict: bool = False
) -> DataFrame:
    """Cast identifiers to long: the listed columns, else every column with the suffix."""
    chosen = [c for c in df.columns if c.endswith(suffix)] if cols is None else cols
    return cast_columns(df, {c: "long" for c in chosen}, strict)


def parse_dates(
    df: DataFrame,
    dates: Iterable[str] = (),
    timestamps: Iterable[str] = (),
    strict: bool = False,
) -> DataFrame:
    types = {c: "date" for c in dates} | {c: "timestamp" for c in timestamps}
    return cast_columns(df, types, strict)


def reject_counts(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Per column: how many non-NULL values the cast to ``types`` turns into NULL (one row)."""
    return df.agg(
        *[
            F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(c)
            for c, t in types.items()
        ]
    )
