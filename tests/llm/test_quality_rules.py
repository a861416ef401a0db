import math

import xxhash
from pyspark.sql import functions as F

from brute import WORD, base_counts
from conftest_llm import ODD, prose
from shopmill.llm import quality_rules as Q

BUCKETS = 64


def _hash(word: str, seed: int = 42) -> int:
    return xxhash.xxh64_intdigest(word.encode(), seed)


def _features(text):
    """Buckets by the published hash: a pair hashes the second word's hash on top of the first's."""
    hashes = [_hash(w) for w in WORD.findall(text or "")]
    both = zip(hashes, hashes[1:])
    chained = [xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42)) for a, b in both]
    return [h % BUCKETS for h in hashes] + [BUCKETS + h % BUCKETS for h in chained]


def _ratios(docs, trusted):
    raw, aim = [0] * (2 * BUCKETS), [0] * (2 * BUCKETS)
    for key, text in docs:
        for f in _features(text):
            raw[f] += 1
            aim[f] += key in trusted
    log = lambda n, total: math.log((n + 1) / (total + 2 * BUCKETS))
    return [round(1e6 * (log(a, sum(aim)) - log(r, sum(raw)))) for a, r in zip(aim, raw)]


def test_counts_ratio_and_verdict_equal_brute_force(spark, odd):
    docs = [d for d in ODD] + [(20 + i, prose(50 + i, 60 + i)) for i in range(20)]
    docs += [(50, "a b c\n" * 40), (51, "a b c\na b c d | # x\n\na b c"), (52, "x y z x y z x")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    trusted = spark.createDataFrame([(i,) for i in (1, 20, 22, 24, 24)] + [(None,)], "doc_id long")
    model = Q.fit(df, trusted, buckets=BUCKETS)
    want = _ratios(docs, {1, 20, 22, 24})
    got = {r["bucket"]: r["ratio"] for r in model.collect()}
    assert [got[i] for i in range(2 * BUCKETS)] == want
    judged = Q.judge(df, model, buckets=BUCKETS, threshold=0.0).select("doc_id", "text", "quality.*")
    rows = judged.collect()
    assert len(rows) == len(docs)
    for r in rows:
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        assert tuple(r[n] for n in names) == base_counts(r["text"])
        features = _features(r["text"])
        mean = sum(want[f] for f in features) / (len(features) * 1e6) if features else 0.0
        assert math.isclose(r["ratio"], mean, abs_tol=1e-12)
        assert r["kept"] == (not r["base_failed"] and r["ratio"] >= 0)


def test_empty_tables_and_clashing_columns(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long")
    model = Q.fit(empty, none, buckets=BUCKETS)
    assert {r["ratio"] for r in model.collect()} == {0}
    assert Q.judge(empty, model, buckets=BUCKETS).count() == 0
    clash = odd.withColumns({c: F.lit("x") for c in ("quality", "n_words", "bucket", "kept")})
    judged = Q.judge(clash, model, buckets=BUCKETS)
    assert judged.columns == clash.columns and judged.count() == odd.count()
    assert judged.select("n_words").distinct().collect()[0][0] == "x"


def test_junk_scores_below_prose(spark):
    good = [(i, prose(i, 100)) for i in range(60)]
    bad = [(100 + i, " ".join(w + "&&&" for w in prose(i, 100).split())) for i in range(20)]
    df = spark.createDataFrame(good + bad, "doc_id long, text string")
    model = Q.fit(df, spark.createDataFrame([(i,) for i in range(30)], "doc_id long"), buckets=1024)
    judged = Q.judge(df, model, buckets=1024, threshold=-0.5)  # a corpus this small is noisy
    kept = {r["doc_id"] for r in judged.filter("quality.kept").collect()}
    assert kept == set(range(60))


def test_no_python_in_the_plan(spark, odd):
    model = Q.fit(odd, odd, buckets=BUCKETS)
    plan = Q.judge(odd, model, buckets=BUCKETS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan.split("Subquery")[0]
