"""Building blocks that keep joins, rankings and intermediates whole and balanced.

Plans stay lazy and declarative: Spark's own statistics and thresholds decide on broadcasts, and
adaptive execution splits the hot partitions of a join by bytes at run time.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BOUNDARIES = 1024  # ranges that a global rank is cut into
COARSE = 32
HOT_KEYS, HOT_SHARE, SALTS = 64, 0.002, 32  # keys looked for, rows that make one hot, parts it is dealt to

_LOCAL_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """This session's own folder under ``spark.checkpoint.dir``, for written intermediates.

    The setting must name a folder that all executors share. Where it is unset, a session on one
    machine gets a temporary folder and a cluster is refused. ``release`` removes the folder.
    """
    app = spark.sparkContext.applicationId
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return f"{named.rstrip('/')}/shopmill-{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="shopmill-")
    return _LOCAL_ROOTS[app]


def scratch(spark: SparkSession) -> str:
    """A new path for one intermediate."""
    return f"{checkpoint_root(spark)}/{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever it lies, through Hadoop's file system of its scheme."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Delete all intermediates of this session, once nothing reads them any more."""
    remove(spark, checkpoint_root(spark))


def durable(df: DataFrame, path: str | None = None, compression: str = "snappy") -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives lost executors."""
    path = path or scratch(df.sparkSession)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def kept(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """``durable`` for the length of a block, as small as it gets; what it wrote is removed at the end."""
    home = scratch(spark)
    try:
        yield lambda df: durable(df, f"{home}/{uuid.uuid4().hex}", "zstd")
    finally:
        remove(spark, home)


def skew_join(
    left: DataFrame, right: DataFrame, key: str, how: str = "inner", unique: str | None = None
) -> DataFrame:
    """Equi-join on ``key`` that stays balanced when one key holds a large part of either side.

    ``how``: inner, left, left_semi or left_anti. Adaptive execution splits hot keys of the left
    side in each of these, and of the right side in an inner join. It can not split the right side of
    an outer join, so unless the right side has one row per key (``unique="right"``), a left join splits
    its hot keys itself (``_left_join``). A semi or anti join needs the right side's keys only: where they are
    not unique they are made so first, map side before the shuffle, which folds a hot key there; where they
    are, the join meets the bare shuffle and hot keys of the left side can be split.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    if how in ("left_semi", "left_anti"):
        keys = right.select(key)
        return left.join(keys if unique == "right" else keys.distinct(), key, how)
    if how == "inner" or unique == "right":
        return left.join(right, key, how)
    return _left_join(left, right, key)


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> Column:
    """The keys that hold at least ``share`` of the rows, as an array: a scalar subquery over the key column.

    A frequency sketch of fixed size counts them; it may miss a key near the bound or name one below, never one
    that the rows do not have.
    """
    top = F.expr(f"approx_top_k(`{key}`, {HOT_KEYS}, {HOT_KEYS * 16})")
    found = df.filter(F.col(key).isNotNull()).agg(top.alias("top"), F.count("*").alias("n"))
    often = F.filter("top", lambda x: x["count"] >= F.col("n") * share)
    return found.select(F.transform(often, lambda x: x["item"])).scalar()


def _left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join in one pass over the left side, hot keys of the right side dealt out.

    Right rows of a hot key get one of ``SALTS`` numbers by a hash of the row, left rows of it come once for each
    number. A hot key does occur on the right, so a left row that misses one number meets another: such misses go, and every
    other left row without a match stays. Building the join runs no job.
    """
    hot = hot_keys(right, key)
    is_hot = F.coalesce(F.array_contains(hot, F.col(key)), F.lit(False))
    every = F.sequence(F.lit(0), F.lit(SALTS - 1))
    ours = left.withColumn("__hot", is_hot)
    ours = ours.withColumn("__salt", F.explode(F.when(F.col("__hot"), every).otherwise(F.array(F.lit(0)))))
    salt = F.pmod(F.xxhash64(*right.columns), F.lit(SALTS)).cast("int")
    theirs = right.withColumns({"__salt": F.when(is_hot, salt).otherwise(0), "__met": F.lit(True)})
    joined = ours.join(theirs, [key, "__salt"], "left")
    return joined.filter(F.col("__met").isNotNull() | ~F.col("__hot")).drop("__hot", "__salt", "__met")


def same(left: Sequence[str], right: Sequence[str]) -> Column:
    """NULL-safe equality of columns by pairs."""
    return reduce(and_, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])


def _range_of(score: str, bounds: list) -> Column:
    """How many of the descending ``bounds`` lie above the score; NULL comes after all."""
    if not bounds:
        return F.lit(0)
    above = lambda listed: F.size(F.filter(listed, lambda b: b > F.col(score)))
    every = F.array(*[F.lit(b) for b in bounds])
    coarse = above(F.array(*[F.lit(b) for b in bounds[COARSE - 1 :: COARSE]]))
    fine = above(F.slice(every, coarse * COARSE + 1, F.lit(COARSE)))
    return F.when(F.col(score).isNull(), len(bounds)).otherwise(coarse * COARSE + fine)


def global_rank(df: DataFrame, score: str, out: str = "rank", ranges: int = BOUNDARIES) -> DataFrame:
    """``rank() over (order by score desc nulls last)`` without moving all rows to one task.

    Only distinct scores with their counts are ranked: a sample of them (those of least hash, at
    most ``ranges``) cuts the score's domain into ranges of about equal numbers, each range is summed on
    its own, one row per range supplies what precedes it, and ranks join back to the rows by score.
    ``df`` is written once while the plan is built, so what lies behind it runs one time; sample and ranks read that.
    """
    df = durable(df)
    counts = df.groupBy(score).agg(F.count("*").alias("_c"))
    known = counts.filter(F.col(score).isNotNull()).select(score)
    sample = known.orderBy(F.xxhash64(score), score).limit(ranges - 1).collect()
    bounds = sorted((r[0] for r in sample), reverse=True)
    ranged = counts.withColumn("_range", _range_of(score, bounds))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_range").agg(F.sum("_c").alias("_total"))  # one row a range
    offsets = offsets.select("_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    inside = (
        Window.partitionBy("_range")
        .orderBy(F.col(score).desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ahead = F.coalesce(F.sum("_c").over(inside), F.lit(0))
    ranks = ranged.withColumn("_ahead", ahead).join(F.broadcast(offsets), "_range")
    ranks = ranks.select(
        F.col(score).alias("_score"), (F.col("_before") + F.col("_ahead") + 1).cast("long").alias(out)
    )
    return df.join(ranks, same([score], ["_score"])).select(*df.columns, out)
