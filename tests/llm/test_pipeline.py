"""The pipeline against plain Python versions of its stages, and the guard that lets it be absent."""

import subprocess
import sys
from pathlib import Path

import corpus_pipeline as P
from brute import near_components, secret_base, sha
from shopmill.llm import bpe, decontamination, queries

ROOT = Path(__file__).resolve().parents[2]
FOLDER = "/root/testdata/sf0.001"


def _norm(text):
    return " " + " ".join("".join(c if c.isalnum() else " " for c in text.lower()).split()) + " "


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    after = []
    for name, stage in P.STAGES:
        docs = stage(spark, docs, FOLDER)
        after.append([r.asDict() for r in docs.collect()])
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns
            docs = spark.createDataFrame([tuple(r.values()) for r in after[-1]], docs.schema)
    quality, near, clean, masked, tokens = after
    verdicts = {r["doc_id"]: r["kept"] for r in queries.QUERIES["op1_quality_rules"](spark, FOLDER).collect()}
    assert {r["doc_id"] for r in quality} == {i for i, kept in verdicts.items() if kept}
    parts = near_components([(r["doc_id"], r["text"]) for r in quality], 5)
    assert {r["doc_id"] for r in near} == {i for i, (_, c) in parts.items() if i == c}
    items = [_norm(r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    matchers = decontamination.Matcher([(i, t) for i, t in enumerate(items) if len(t.split()) >= 8], 0.15)
    assert {r["doc_id"] for r in clean} == {r["doc_id"] for r in near if not matchers(_norm(r["text"]))}
    assert all(not any(t in _norm(r["text"]) for t in items) for r in clean)
    whole = {r["doc_id"]: r["text"] for r in clean}
    assert {r["doc_id"] for r in masked} == set(whole)
    for r in masked:
        if not secret_base(whole[r["doc_id"]]):
            assert r["text"] == whole[r["doc_id"]]
        assert not secret_base(r["text"]) and r["n_chars"] == len(r["text"])
    tokenizer = bpe._tokenizer(bpe.vocabulary("word_bpe_49k.json"))
    texts = {r["doc_id"]: r["text"] for r in masked}
    assert {r["doc_id"] for r in tokens} == set(texts)
    for r in tokens:
        ids = tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids"]) == (len(ids), ids)
        assert r["ids_sha256"] == sha(" ".join(map(str, ids)))


def test_run_takes_odd_rows(spark, odd, tmp_path):
    docs = odd.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "1L AS n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    trusted = [(1, 1, 0), (6, 1, 0), (7, 1, 0), (None, 1, None)]
    spark.createDataFrame(trusted, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = [r["doc_id"] for r in P.run(spark, str(tmp_path)).collect()]
    assert 1 in kept and 6 not in kept and len(kept) == len(set(kept))


def test_planted_secrets_with_punctuation_are_masked_whole(spark):
    values = ["hunter22!x#y9", "Zk8!qP2v,Lm(9)w;", f"{'0123456789abcdef' * 2}.Zk8!qP"]
    names = ["password", "api_key", "signing_key"]
    rows = [(i, f'a line\n{n} = "{v}"\nanother', "en", "s", 1) for i, (n, v) in enumerate(zip(names, values))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r for r in P.secret_free(spark, docs, FOLDER).collect()}
    for i, name in enumerate(names):
        kept = "" if name == "password" else f'{name} = "'  # a base span takes the name along
        assert got[i]["text"] == f'a line\n{kept}[SECRET]"\nanother' and got[i]["n_chars"] == len(got[i]["text"])


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    text = "one two three four five six\npassword = 'hunter22'\n"
    docs = [(1, text, 1, 2, 3, 4), (2, None, 1, 2, 3, 4), (3, "asked who wrote the play Faust again", 1, 2, 3, 4)]
    kind = "doc_id long, text string, n_chars long, _quality int, _matches int, _secrets int"
    df = spark.createDataFrame(docs, kind)
    spark.createDataFrame([(1, "Who wrote the play Faust?")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    clean = P.benchmark_free(spark, df, str(tmp_path))
    assert clean.columns == df.columns and sorted(tuple(r)[0] for r in clean.collect()) == [1, 2]
    masked = P.secret_free(spark, df, str(tmp_path))
    rows = {r["doc_id"]: tuple(r) for r in masked.collect()}
    assert masked.columns == df.columns and rows[2] == docs[1] and rows[3] == docs[2]
    assert "hunter22" not in rows[1][1] and rows[1][3:] == (2, 3, 4)
    kept = P.quality(spark, df, str(tmp_path))
    assert kept.columns == df.columns and kept.count() == 0  # all too short


def test_verbatim_short_items_are_evidence(spark, tmp_path):
    items = [(1, "Who wrote the play Faust?"), (2, "the end")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = [(1, "asked who wrote the play Faust again"), (2, "this is the end"), (3, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    kept = P.benchmark_free(spark, df, str(tmp_path))
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3] and kept.columns == df.columns


def test_run_of_an_empty_table(spark, tmp_path):
    kinds = {"documents": "doc_id long, text string, lang string, source string, n_chars long",
             "labels": "doc_id long, quality int, toxic int", "benchmark": "item_id long, text string"}
    for name, kind in kinds.items():
        spark.createDataFrame([], kind).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0


def test_the_rest_works_without_this_package(tmp_path):
    """A copy of the repository without the text operators and the pipeline still imports."""
    import shutil

    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert 'r01_totals' in q and 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, timeout=120)
