import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import near_components
from conftest_llm import prose
from shopmill.llm import near_dedup as N


def _edited(text, seed, share):
    r = random.Random(seed)
    return " ".join(w if r.random() > share else f"new{r.randrange(10**6)}" for w in text.split())


def _corpus():
    docs = [(i, prose(i, 60)) for i in range(40)]
    docs += [(100 + i, _edited(docs[0][1], i, 0.04)) for i in range(60)]  # a group around one text
    docs += [(200 + i, _edited(docs[1][1], i, 0.10)) for i in range(30)]  # many pairs near the bound
    chain = docs[2][1].split()
    for i in range(12):  # each next to the last only
        chain = [f"step{i}", f"more{i}", *chain[: len(chain) - 2]]
        docs.append((300 + i, " ".join(chain)))
    docs += [(400 + i, docs[3][1].upper()) for i in range(20)]
    docs += [(500, None), (501, ""), (502, " \n "), (503, "one"), (504, "One"), (505, "x" * 5000)]
    return docs


@pytest.mark.parametrize("width", [2, 5])
@pytest.mark.parametrize("rounds", [0, 8])
def test_components_equal_exact_ones(spark, width, rounds):
    docs = _corpus()
    found = N.components(spark.createDataFrame(docs, "doc_id long, text string"), width=width, rounds=rounds)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()}
    assert got == near_components(docs, width)


def test_odd_rows(odd, empty, spark):
    rows = N.components(odd, width=2).collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"]}
    assert by_id[1][1] == by_id[6][1] == 1 and by_id[2] == (0, 2) and by_id[3] == (0, 3)
    assert {r["component_id"] for r in rows if r["doc_id"] is None} == {None}
    assert N.components(empty).count() == 0
    clash = odd.withColumns({c: F.lit(1) for c in ("n_shingles", "component_id", "node", "_t", "band")})
    assert N.components(clash, width=2).count() == odd.count()


def test_keep_one(odd, empty, spark):
    kept = N.keep_one(odd, width=2)
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] or 0, r["text"] is None) for r in kept.collect())
    assert ids == [(0, False), (0, True), (1, False), (2, True), (3, False), (4, False), (5, False), (7, False), (8, False), (9, False)]
    assert N.keep_one(empty).count() == 0
    again = N.keep_one(spark.createDataFrame([(1, "a b c")] * 5, "doc_id long, text string"), width=2)
    assert again.count() == 1


def test_keep_one_of_near_copies_with_equal_or_no_keys(spark):
    words = [f"w{i}" for i in range(200)]
    copies = [" ".join([*words, f"end{i}"]) for i in range(3)]
    other = [" ".join([*(f"v{i}" for i in range(200)), f"end{i}"]) for i in range(3)]
    rows = [(None, t) for t in copies + copies] + [(4, t) for t in other] + [(None, other[0]), (None, ""), (None, "")]
    kept = [tuple(r) for r in N.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len(kept) == 4 and kept.count((None, "")) == 2
    assert [k for k, t in kept if t in other] == [4] and [k for k, t in kept if t in copies] == [None]


def test_signatures_are_circulant_and_estimate_similarity():
    r = np.random.default_rng(3)
    shared = r.integers(0, 2**63, 800, dtype=np.uint64)
    a = np.concatenate([shared, r.integers(0, 2**63, 200, dtype=np.uint64)])
    b = np.concatenate([shared, r.integers(0, 2**63, 200, dtype=np.uint64)])
    both = N.signatures(np.concatenate([a, b]), np.array([0, len(a)]), 512)
    assert abs((both[0] == both[1]).mean() - 800 / 1200) < 0.08
    x = np.arange(2**16, dtype=np.uint32)
    assert len(np.unique(N._mix(x.copy()))) == len(x)  # one to one


def test_keep_one_leaves_columns_of_any_name_alone(spark):
    text = prose(1, 60)
    rows = [(1, text, 10, "a", True, "x"), (2, text, 20, "b", False, "y"), (None, text, 30, "c", True, "z"), (3, None, 40, "d", True, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _t long, _k string, _blank boolean, _id string")
    assert sorted(map(tuple, N.keep_one(docs).collect())) == [rows[0], rows[3]]
