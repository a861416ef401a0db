import pytest
from pyspark.sql import functions as F

from brute import sha
from conftest_llm import ODD, prose
from shopmill.llm import bpe

public = pytest.importorskip("public_tokenizers")
PATH = public.path("word_bpe_49k.json")
TEXTS = [
    "It's the DON'T we'll 12.5% <|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>", "ÀÉÎ œuvre ŉ ǅ İstanbul ΣΑΣ ß ½²",
    "é àḅ̇ Å ﬁ 한글 한", "tabs\tand\x0bvertical\x0cfeeds\r\nnbsp here wide　x\x1cy\x85z",
    "'s 't 'x '' !!'s \"quoted\" (a)[b]{c} a--b __x__", "😀👍🏽 zero​width ﻿bom ­soft", "A" * 3000 + " " + "ab1" * 500,
]


@pytest.mark.parametrize("head", [bpe.HEAD, 3, 0])
def test_ids_and_text_equal_the_library(spark, head):
    tokenizer = bpe._tokenizer(PATH)
    docs = ODD + [(100 + i, t) for i, t in enumerate(TEXTS)] + [(200 + i, prose(i, 50)) for i in range(10)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    want = []
    for key, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        want.append((key, len(ids), tuple(ids), tokenizer.decode(ids, skip_special_tokens=False)))
    rows = bpe.encode(df, PATH, head=head).collect()
    assert sorted([(r[0], r[1], tuple(r[2]), r[3]) for r in rows], key=repr) == sorted(want, key=repr)
    digests = bpe.encode(df, PATH, head=head, outputs=("ids_sha256", "decoded_sha256")).collect()
    hashed = [(k, n, sha(" ".join(map(str, ids))), sha(text)) for k, n, ids, text in want]
    assert sorted(map(tuple, digests), key=repr) == sorted(hashed, key=repr)


def test_each_distinct_word_once(spark, odd, empty):
    table = bpe.word_table(odd, PATH)
    assert table.count() == table.select("word").distinct().count()
    assert bpe.encode(empty, PATH).count() == 0
    clash = odd.withColumns({c: F.lit(1) for c in ("n_tokens", "word", "ids", "_a", "_key")})
    assert bpe.encode(clash, PATH).columns == ["doc_id", "n_tokens", "ids", "decoded"]


def test_most_frequent_words_without_a_sort_in_one_task(spark):
    counts = [(f"w{i}", 1 + 5000 // (i + 1)) for i in range(3000)]
    df = spark.createDataFrame(counts, "word string, n long").repartition(4)
    for most in (0, 10, 100, 1000, 5000):
        kept = bpe.frequent(df, most).collect()
        assert len(kept) <= most * 1.2 + 5 and len(kept) >= min(most, 3000) * 0.8 - 5
        least = min((r["n"] for r in kept), default=0)
        left = {w for w, _ in counts} - {r["word"] for r in kept}
        assert all(n <= least * 2 ** (1 / 8) + 1 for w, n in counts if w in left or not kept) or most == 0
    assert "TakeOrdered" not in bpe.frequent(df, 100)._jdf.queryExecution().executedPlan().toString()


CUTS = [
    "it's IT'S we'll'll 're'd ''s !'s 's! x'sample 'tis l'l 'l 'v 've1 'reé 'r", "1²½12 a1b é1É ß×÷¡¿ µªº ŉſŸ", "",
    "a<|b", "<", "|x", " \t\n", "ƁaɁ xȺy ƀɏ", "İx", "한 a", "a\x85b\xa0c", "\x7f\x00", "e\u0301 's", "'", "s", "'", "\x1cq", "plain Words, again",
]


def test_array_cut_equals_cutting_one_by_one():
    import random

    import pyarrow as pa

    draw = random.Random(5)
    signs = "".join(CUTS)
    texts = CUTS + ["".join(draw.choices(signs, k=draw.randrange(30))) for _ in range(2000)]
    words, sizes = bpe.cut(pa.array(["skipped", *texts], pa.string()).slice(1))
    assert words.to_pylist() == [w for t in texts for w in bpe.words_of(t)]
    assert sizes.tolist() == [len(bpe.words_of(t)) for t in texts]
    none = bpe.cut(pa.array([], pa.string()))
    assert len(none[0]) == 0 and len(none[1]) == 0


def test_letters_whose_lower_case_lies_beyond_latin(spark):
    """Their words were cut behind such a letter."""
    tokenizer = bpe._tokenizer(PATH)
    texts = ["Ɓa ƁƁ", "aƁ1", "xȺy Ɏ'll", "ƀƁ ɏz"]
    rows = bpe.encode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), PATH).collect()
    assert {r[0]: list(r[2]) for r in rows} == {
        i: tokenizer.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts)
    }
