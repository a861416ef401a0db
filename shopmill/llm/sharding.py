"""Sharding: a uniform shuffle with exact shard sizes through a hypergeometric communication matrix.

The rows lie in input partitions of ``n_i`` rows. How many rows each partition sends to each shard is
drawn first, from the multivariate hypergeometric law that a uniform shuffle would induce; its
column sums are the shard sizes, at most one apart. Then each partition orders its rows at random
and deals them out by that matrix, rows are exchanged, and each shard orders what it got at random.

Only the matrix (partitions x shards counts, no rows) is made on the driver. The second permutation
of a shard is cut into buckets by the leading bits of a random key, so no task holds a whole shard.

Defined cases: a NULL text has size 1 and the checksum of the empty text, an empty table gives no
rows, repeated rows are separate rows, NULL ids are kept. Other columns are ignored, also ones named like the
result's. One seed gives one result for the same input split; the partition of each row is written down before use, so a
task that runs again deals its rows as before.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopmill.llm.common import text_of
from shopmill.operators.scale import durable

SEED = 20240
BUCKET_ROWS = 200_000
LIBRARY_LIMIT = 10**9  # numpy draws from populations below this


def _draw(random: np.random.Generator, good: int, bad: int, n: int) -> int:
    """A hypergeometric count for a population of any size, by inversion of the exact mass function.

    Probabilities come from the ratio of neighbours, outwards from the mode over 12 standard
    deviations, so the work follows the spread, not the population.
    """
    total = good + bad
    low, high = max(0, n - bad), min(n, good)
    share = good / total if total else 0.0
    mode = min(max(int((n + 1) * ((good + 1) / (total + 2))), low), high)
    reach = int(12 * (n * share * (1 - share)) ** 0.5) + 30
    a, b = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(a, b, dtype=np.float64)
    ratio = (good - k) * (n - k) / ((k + 1) * (bad - n + k + 1))  # p(k + 1) / p(k)
    log_p = np.concatenate([[0.0], np.cumsum(np.log(ratio))])
    p = np.exp(log_p - log_p.max())
    return a + int(np.searchsorted(np.cumsum(p), random.random() * p.sum(), side="right"))


def communication_matrix(counts: list[int], sizes: list[int], seed: int = SEED) -> np.ndarray:
    """Rows to send from each partition to each shard: margins ``counts`` and ``sizes``."""
    if sum(counts) != sum(sizes):
        raise ValueError("counts and sizes differ in sum")
    random = np.random.default_rng(seed)
    left = np.array(sizes, dtype=np.int64)
    matrix = np.zeros((len(counts), len(sizes)), dtype=np.int64)
    rows = sum(sizes)
    for i, n in enumerate(counts):
        if rows < LIBRARY_LIMIT:  # the marginals method needs memory by shards, not by rows
            matrix[i] = random.multivariate_hypergeometric(left, n, method="marginals")
        else:
            wanted, rest = n, rows
            for j in range(len(sizes)):
                rest -= int(left[j])
                matrix[i, j] = _draw(random, int(left[j]), rest, wanted) if wanted else 0
                wanted -= int(matrix[i, j])
        left -= matrix[i]
        rows -= n
    return matrix


def _random(seed: int, *columns: str) -> Column:
    return F.xxhash64(F.lit(seed).cast("long"), *columns)


def shuffle_into_shards(
    rows: DataFrame, shards: int, seed: int = SEED, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in a shard), uniformly at random.

    ``rows`` must not have columns of these names or starting with ``_s_``. Carry narrow rows (ids): they are
    written once and shuffled twice.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    placed = durable(
        rows.withColumns(
            {"_s_part": F.spark_partition_id(), "_s_at": F.monotonically_increasing_id()}
        )
    )
    counted = placed.groupBy("_s_part").count().orderBy("_s_part").collect()  # one row a partition
    counts = [r["count"] for r in counted]
    total = sum(counts)
    sizes = [total // shards + (j < total % shards) for j in range(shards)]
    spark = rows.sparkSession
    ends = communication_matrix(counts, sizes, seed).cumsum(axis=1).tolist()
    plan = spark.createDataFrame(
        [(r["_s_part"], e) for r, e in zip(counted, ends)], "_s_part int, _s_ends array<long>"
    )

    # First permutation, inside each input partition, then dealt out by its row of the matrix.
    local = Window.partitionBy("_s_part").orderBy(_random(seed, "_s_at"), "_s_at")
    turn = F.row_number().over(local)
    dealt = (
        placed.withColumn("_s_turn", turn)
        .join(plan, "_s_part")  # lies by partition already
        .withColumn("shard", F.size(F.filter("_s_ends", lambda e: e < F.col("_s_turn"))))
    )

    # Second permutation, inside each shard, in buckets of a uniform key of even size.
    buckets = max(1, -(-total // (shards * bucket_rows)))
    dealt = dealt.withColumn("_s_key", _random(seed + 1, "_s_at"))
    bucket = F.shiftrightunsigned("_s_key", 33) * buckets / F.lit(float(1 << 31))
    dealt = durable(dealt.withColumn("_s_bucket", F.floor(bucket)).drop("_s_ends", "_s_turn", "_s_part"))
    before = Window.partitionBy("shard").orderBy("_s_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("shard", "_s_bucket")
        .agg(F.count("*").alias("_s_n"))
        .withColumn("_s_start", F.coalesce(F.sum("_s_n").over(before), F.lit(0)))
        .drop("_s_n")
    )
    order = Window.partitionBy("shard", "_s_bucket").orderBy(
        F.shiftrightunsigned("_s_key", 1), "_s_at"
    )
    return (
        dealt.withColumn("_s_rank", F.row_number().over(order))
        .join(starts, ["shard", "_s_bucket"])  # one row a bucket of bucket_rows rows
        .withColumn("slot", F.col("_s_start") + F.col("_s_rank") - 1)
        .select(*rows.columns, "shard", "slot")
    )


def shard_documents(
    docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text", seed: int = SEED
) -> DataFrame:
    """``key, size, text_crc32, shard, slot`` for every row of ``docs``."""
    rows = docs.select(
        F.col(key),
        (F.octet_length(text_of(text)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text_of(text), "utf-8")).alias("text_crc32"),
    )
    return shuffle_into_shards(rows, shards, seed)
