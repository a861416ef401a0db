"""Repeated passages against a table of all windows."""

import random
import re
from hashlib import sha256

import pyarrow as pa
import pytest
from conftest_llm import ODD, prose

from shopmill.llm import queries, substring_dedup
from shopmill.llm.wordtable import cut

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window=50):
    """(id, words, removed, kept text) of every row."""
    cut_up = [(k, WORD.findall(t or "")) for k, t in rows]
    least = {}
    for k, words in cut_up:
        for i in range(len(words) - window + 1 if k is not None else 0):
            w = tuple(words[i : i + window])
            least[w] = min(k, least.get(w, k))
    found = []
    for k, words in cut_up:
        gone = set()
        for i in range(len(words) - window + 1 if k is not None else 0):
            if least[tuple(words[i : i + window])] < k:
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        found.append((k, len(words), len(gone), kept))
    return sorted(found, key=repr)


def result(df):
    return sorted(((r["doc_id"], *r["repeats"]) for r in df.collect()), key=repr)


def corpus(seed, n=60):
    """Texts with shared passages, whole copies, prefixes, rotated and repeated passages."""
    r = random.Random(seed)
    passages = [prose(seed * 100 + i, r.randint(8, 90)) for i in range(6)]
    rows = []
    for i in range(n):
        parts = [prose(10_000 + seed * 1000 + i * 10 + j, r.randint(0, 60)) for j in range(3)]
        for p in r.choices(passages, k=r.randint(0, 3)):
            parts.insert(r.randint(0, len(parts)), p)
        rows.append((r.randint(0, 2 * n), r.choice([" ", "\n", " \t"]).join(parts)))
    rows += [(5, rows[0][1]), (900, rows[1][1]), (901, rows[1][1] + " more"), (902, "x y " * 200), (1, "x y " * 90)]
    return rows


@pytest.mark.parametrize("window", [2, 5, 12, 50])
@pytest.mark.parametrize("hot", [4096, 3])
def test_equals_all_windows(spark, window, hot):
    rows = corpus(window)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = result(substring_dedup.strip_repeats(docs, window, hot=hot))
    assert got == brute(rows, window)
    assert any(r[2] for r in got) and any(not r[2] and r[1] > window for r in got)


def test_one_passage_in_most_rows_goes_through_split_buckets(spark):
    passage = prose(1, 70)
    rows = [(i, f"{prose(100 + i, 30)} {passage} {prose(900 + i, 30)}") for i in range(120)]
    rows += [(500 + i, rows[3][1]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for hot in (50, 4096):
        assert result(substring_dedup.strip_repeats(docs, hot=hot)) == brute(rows)


def test_odd_rows(spark, odd, empty):
    assert result(substring_dedup.strip_repeats(odd)) == brute(ODD)
    assert substring_dedup.strip_repeats(empty).collect() == []
    with pytest.raises(ValueError):
        substring_dedup.strip_repeats(odd, 1)


def test_rows_of_one_id_and_rows_without_id_remove_nothing(spark):
    a, b = prose(1, 80), prose(2, 80)
    rows = [(3, a), (3, f"{a} {b}"), (None, a), (None, b), (2, b), (3, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(substring_dedup.strip_repeats(docs)) == brute(rows)


def test_clashing_columns_stay(spark):
    text = prose(1, 60)
    docs = spark.createDataFrame(
        [(1, text, 7, 8, "n", "old"), (2, text, 9, 9, "n", "old")],
        "doc_id long, text string, _a long, starts long, _text string, repeats string",
    )
    got = sorted(substring_dedup.strip_repeats(docs).collect())
    assert [(r["_a"], r["starts"], r["_text"], r["repeats"]["n_removed"]) for r in got] == [(7, 8, "n", 0), (9, 9, "n", 60)]


def test_stretches_cover_each_window_once():
    words = cut(pa.array([prose(1, 300), "a " * 500, "b", None, prose(2, 55)]))
    first, windows, _ = substring_dedup.superkmers(words, 50)
    covered = [i for f, n in zip(first.tolist(), windows.tolist()) for i in range(f, f + n)]
    bounds = list(zip(words.first.tolist(), words.first.tolist()[1:]))
    assert covered == [i for a, b in bounds for i in range(a, b - 49)]
    assert windows.max() <= substring_dedup.LONGEST
    strings = substring_dedup.packed(words, first, windows, 50)
    assert [len(s.split()) for s in strings] == (windows + 49).tolist()
    assert [len(substring_dedup._windows(s, 50)) for s in strings] == windows.tolist()


def test_query_equals_brute_force_on_the_small_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op13_substring_dedup"](spark, folder).collect()
    want = [(k, n, gone, sha256(t.encode()).hexdigest()) for k, n, gone, t in brute(rows)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert sum(r["n_removed"] > 0 for r in got) > 10
