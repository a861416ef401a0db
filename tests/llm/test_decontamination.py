import random

from pyspark.sql import functions as F

from conftest_llm import prose
from shopmill.llm import decontamination as D


def _distance(pattern, text):
    """Least edits of the word list against any stretch, by the plain table."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for w in text:
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i] + 1, new[i - 1] + 1, row[i - 1] + (p != w)))
        row = new
        best = min(best, row[-1])
    return best


def _changed(words, seed, edits):
    r, words = random.Random(seed), list(words)
    for _ in range(edits):
        at = r.randrange(len(words))
        kind = r.choice("ird")
        if kind == "d":
            del words[at]
        else:
            words[at : at + (kind == "r")] = [f"w{r.randrange(99)}"]
    return words


def test_matches_equal_the_plain_table(spark):
    items = [(i, prose(900 + i, 8 + 3 * i)) for i in range(12)] + [(50, prose(900, 8)), (51, "too few words"), (52, None)]
    docs = []
    for i in range(60):
        item = items[i % 12][1].split()
        inside = _changed(item, i, i % 9)
        docs.append((i, prose(i, 40) + ". " + ", ".join(inside).upper() + "! " + prose(70 + i, i)))
    docs += [(100, None), (101, ""), (102, items[0][1]), (102, items[0][1]), (None, items[1][1] + " " + items[1][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("rest", F.lit(1))
    queries = spark.createDataFrame(items, "item_id long, text string")
    norm = lambda t: "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()
    want = {}
    for key, text in docs:
        for item, question in items:
            words = norm(question)
            k = D.budget(len(words), D.ERROR_RATE)
            if len(words) >= D.MIN_WORDS and (d := _distance(words, norm(text))) <= k:
                want[(key, text, item)] = d
    for size in (D.BLOCK_CHARS, 100):  # one block, and several
        marked = D.contamination(df, queries, block_chars=size)
        assert marked.columns == ["doc_id", "text", "rest", "matches"]
        rows = marked.select("doc_id", "text", F.explode("matches").alias("m")).select("doc_id", "text", "m.*").collect()
        assert {(r["doc_id"], r["text"], r["item"]): r["edits"] for r in rows} == want
        for r in rows:
            found = norm(r["text"])[r["first_word"] : r["first_word"] + r["words"]]
            assert _distance(norm(dict(items)[r["item"]]), found) == r["edits"]
    assert any(d > 0 for d in want.values())


def test_short_items_and_scripts_without_spaces_are_searched(spark):
    items = [
        (1, "Who wrote Faust?"), (2, "日本の首都はどこですか、教えてください"), (3, "ไทยมีเมืองหลวงชื่ออะไรบ้าง"), (4, "กี"), (5, "x"),
        (6, "..."),
    ]
    docs = [
        (1, "asked: who WROTE faust, again"), (2, "who really wrote faust"), (3, "さて、日本の首都はどこですか教えて下さい。次"),
        (4, "และไทยมีเมืองหลวงชื่ออะไรบ้างครับ"), (5, "กา"), (6, "a x b"), (7, "日本の川"),
    ]
    marked = D.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    rows = marked.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*").collect()
    assert {(r["doc_id"], r["item"]): r["edits"] for r in rows} == {(1, 1): 0, (3, 2): 2, (4, 3): 0, (6, 5): 0}
    assert [(r["first_word"], r["words"]) for r in rows if r["doc_id"] == 1] == [(1, 3)]


def test_odd_rows_and_empty_tables(spark, odd, empty):
    none = spark.createDataFrame([], "item_id int, text string")
    assert D.contamination(odd, none).filter("size(matches) > 0").count() == 0
    some = spark.createDataFrame([(1, prose(1, 80)), (1, prose(1, 80))], "item_id int, text string")
    assert D.contamination(empty, some).count() == 0
    marked = D.contamination(odd.withColumn("matches", F.lit(0)).withColumn("item", F.lit(0)), some)
    hit = marked.filter("size(matches) > 0").select("doc_id").collect()
    assert sorted(r[0] for r in hit) == [1, 6, 6] and marked.count() == odd.count()


def test_own_columns_do_not_meet_the_callers(spark):
    items = [(i, prose(500 + i, 20)) for i in range(6)]
    docs = [(i, f"x {prose(500 + i, 20)} y", 7, 8, 9) for i in range(4)] + [(4, None, 7, 8, 9)]
    df = spark.createDataFrame(docs, "doc_id long, text string, _plain int, _mark int, _found int")
    queries = spark.createDataFrame(items, "item_id long, text string")
    for size in (D.BLOCK_CHARS, 100):
        marked = D.contamination(df, queries, block_chars=size)
        assert marked.columns == [*df.columns, "matches"]
        rows = {r["doc_id"]: r for r in marked.collect()}
        assert all((r["_plain"], r["_mark"], r["_found"]) == (7, 8, 9) for r in rows.values())
        assert [[m["item"] for m in rows[i]["matches"]] for i in range(5)] == [[0], [1], [2], [3], []]


def test_a_text_is_searched_once_for_each_block(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    for n, size in ((1, D.BLOCK_CHARS), (5, 30)):
        items = spark.createDataFrame([(i, prose(i, 10)) for i in range(5)], "item_id long, text string")
        found = D.contamination(docs, items, block_chars=size).select("doc_id", F.explode("matches"))
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("ArrowEvalPython") == n


def test_pieces_cover_an_item():
    words = [f"w{i}" for i in range(23)]
    cut = D.pieces(words, 3)
    assert " ".join(p.strip() for _, p in cut).split() == words and [o for o, _ in cut] == [0, 5, 11, 17]
