import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest_llm import ODD
from shopmill.llm import sharding as S


def _laws(rows, shards):
    sizes = Counter(r["shard"] for r in rows)
    counts = [sizes[j] for j in range(shards)]
    assert max(counts) - min(counts) <= 1
    for j in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == j) == list(range(counts[j]))


@pytest.mark.parametrize("bucket_rows", [S.BUCKET_ROWS, 7])
def test_sizes_slots_and_rows(spark, bucket_rows):
    rows = spark.range(1001).repartition(5)
    got = S.shuffle_into_shards(rows, 16, bucket_rows=bucket_rows).collect()
    assert sorted(r["id"] for r in got) == list(range(1001))
    _laws(got, 16)
    assert [tuple(r) for r in S.shuffle_into_shards(rows, 16, bucket_rows=bucket_rows).orderBy("id").collect()] == [
        tuple(r) for r in sorted(got)
    ]


def test_shards_and_slots_do_not_follow_the_input(spark):
    """Chi-squared of (tenth of the input, shard) and (tenth, quarter of the slots), far from the rejecting tail."""
    n = 40_000
    got = S.shuffle_into_shards(spark.range(n).repartition(5), 8, bucket_rows=1000).collect()
    for cell, cells in ((lambda r: r["shard"], 8), (lambda r: r["slot"] * 4 * 8 // n, 4)):
        seen = Counter((r["id"] * 10 // n, cell(r)) for r in got)
        e = n / 10 / cells
        chi = sum((seen[i, c] - e) ** 2 / e for i in range(10) for c in range(cells))
        assert chi < 2.5 * 9 * (cells - 1)


def test_matrix_margins_and_law():
    m = S.communication_matrix([5, 0, 100, 3000], [777, 776, 776, 776], seed=1)
    assert m.sum(axis=0).tolist() == [777, 776, 776, 776] and m.sum(axis=1).tolist() == [5, 0, 100, 3000]
    with pytest.raises(ValueError):
        S.communication_matrix([1], [2])
    r = np.random.default_rng(5)
    own = [S._draw(r, 300, 700, 50) for _ in range(4000)]
    assert abs(np.mean(own) - 15) < 0.3 and abs(np.var(own) - 50 * 0.3 * 0.7 * 950 / 999) < 1
    assert S._draw(r, 0, 5, 3) == 0 and S._draw(r, 5, 0, 5) == 5


def test_large_populations_keep_margins(monkeypatch):
    monkeypatch.setattr(S, "LIBRARY_LIMIT", 10)
    m = S.communication_matrix([5, 0, 100, 3000], [777, 776, 776, 776])
    assert m.sum(axis=0).tolist() == [777, 776, 776, 776] and m.sum(axis=1).tolist() == [5, 0, 100, 3000]


def test_broadcasts_are_left_to_statistics(spark):
    plan = S.shuffle_into_shards(spark.range(100).repartition(5), 4)._jdf.queryExecution().logical().toString()
    assert "broadcast" not in plan.lower()


def test_documents(spark, odd, empty):
    clash = odd.withColumns({c: F.lit("x") for c in ("shard", "slot", "size", "law")})
    rows = S.shard_documents(clash, 4).collect()
    _laws(rows, 4)
    size = lambda t: len((t or "").encode()) + 1
    want = sorted((repr(k), size(t), zlib.crc32((t or "").encode())) for k, t in ODD)
    assert sorted((repr(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == want
    assert S.shard_documents(empty).count() == 0
