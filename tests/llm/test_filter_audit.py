"""The filter audit against filters applied one after the other, and its sketch against exact counts."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from conftest_llm import prose
from pyspark.sql import functions as F

from shopmill.llm import filter_audit, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string"


def failing(text, first):
    words = WORD.findall(text)
    capitals = len(re.findall("[A-Z]", text))
    checks = {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * capitals > 2 * len(text),
        "D": bool(re.search(r"[#$%&*|]", text)),
        "E": first,
    }
    return {c for c, bad in checks.items() if bad}


def brute(rows, labels):
    """(part, order, step) -> kept, removed, redundant, unique, good lost, toxic lost, shapley: by going through."""
    least = {}
    for k, t, _ in rows:
        if k is not None:
            least[t or ""] = min(k, least.get(t or "", k))
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    bad = {k for k, _, x in labels if x == 1 and k is not None}
    marked = defaultdict(list)
    for k, t, s in rows:
        marked[s or ""].append((k, failing(t or "", k is not None and least[t or ""] < k)))
    found = {}
    for part, docs in marked.items():
        total = Counter()
        for order in permutations("ABCDE"):
            left, gone = list(docs), []
            for step, f in enumerate(order, 1):
                out = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                row = [len(left), len(out), sum(f in d[1] for d in gone), sum(d[1] == {f} for d in docs)]
                row += [sum(d[0] in good for d in out), sum(d[0] in bad for d in out)]
                found[part, "".join(order), step] = row
                gone += out
                total[f] += len(out)
        for (p, order, step), row in found.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in found.items()}


def result(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = df.collect()
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in rows}
    assert len(found) == len(rows)
    return found


def corpus(seed):
    r = random.Random(seed)
    long, loud = prose(seed, 260), " ".join(["LOUD"] + prose(seed + 1, 30).split())
    texts = [long, loud, long + " #", "x y " * 150, "", None, " \n", prose(seed + 2, 220), "Ärger " * 250, "A" * 10, "a|b"]
    ids = [None, None, *range(1, 40), 5, 5]
    return [(k, r.choice(texts), r.choice(["s", "t", None, "", "s"])) for k in ids]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_filters_in_every_order(spark, seed):
    rows = corpus(seed)
    labels = [(1, 1, 0), (2, 0, 1), (3, 1, 1), (3, 0, 0), (5, 1, None), (None, 1, 1), (99, 1, 1), (7, None, 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert result(filter_audit.audit(filter_audit.mask_counts(docs, marks))) == brute(rows, labels)


def test_tables_without_rows(spark):
    docs, labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert result(filter_audit.audit(filter_audit.mask_counts(docs, labels))) == {}
    some = spark.createDataFrame([(1, "a", "s")], SCHEMA)
    got = result(filter_audit.audit(filter_audit.mask_counts(some, labels)))
    assert len(got) == 600 and got["s", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120)


def test_columns_of_other_names_and_clashing_ones(spark):
    docs = spark.createDataFrame(
        [(1, "x", "p", 1, "q"), (2, "x", "p", 2, "q")], "k long, body string, shelf string, mask int, part string"
    )
    labels = spark.createDataFrame([(2, 1, 0)], "k long, quality int, toxic int")
    counts = filter_audit.mask_counts(docs, labels, "k", "body", "shelf").collect()
    assert sorted(map(tuple, counts)) == [("p", 1, 1, 0, 0), ("p", 17, 1, 1, 0)]


def test_the_sketch_never_clears_a_repeat(spark):
    """Counters are at least the number of rows that hit them, up to 2, whatever the tasks and slices."""
    hashes = [random.Random(i).getrandbits(63) - (1 << 62) for i in range(3000)]
    hashes += hashes[:300] + hashes[:1] * 500
    rows = spark.createDataFrame([(h,) for h in hashes], "h long").repartition(6)
    for slices in (1, 3, filter_audit.slices_for(len(hashes))):
        counted = filter_audit.sketch(rows, slices)
        assert counted.count() == slices
        left = Counter(r["h"] for r in filter_audit.possible_repeats(rows, counted, slices).collect())
        exact = Counter(hashes)
        assert all(left[h] == n for h, n in exact.items() if n > 1)
        assert sum(exact[h] == 1 for h in left) < 0.15 * 3000


def test_a_sketch_too_large_to_send_is_joined_by_a_shuffle(spark, monkeypatch):
    rows = spark.createDataFrame([(i % 50,) for i in range(99)], "h long").select(F.xxhash64("h").alias("h"))
    counted = filter_audit.sketch(rows, 2)
    sent = filter_audit.possible_repeats(rows, counted, 2)
    assert "BroadcastHashJoin" in sent._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(filter_audit, "SENT_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt = filter_audit.possible_repeats(rows, counted, 2)
        assert "SortMergeJoin" in dealt._jdf.queryExecution().executedPlan().toString()
        assert sorted(dealt.collect()) == sorted(sent.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_query_equals_brute_force_on_the_small_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source").collect()]
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality", "toxic").collect()
    assert result(queries.QUERIES["op12_filter_audit"](spark, folder)) == brute(rows, labels)
