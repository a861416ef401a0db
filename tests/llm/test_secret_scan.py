import time

import pytest
from pyspark.sql import functions as F

from brute import secret_base, sha
from conftest_llm import ODD
from shopmill.llm import queries
from shopmill.llm import secret_scan as S

KEY = "q8Zt3vLw9KpX2mNc"


@pytest.mark.parametrize(
    "text, found",
    [
        (f'db_pwd = "{KEY}"', [KEY]),
        (f"export PRIVATE_KEY='{KEY}'", [KEY]),
        (f'{{"clientCredentials": "{KEY}", "name": "somebody9"}}', [KEY]),
        (f'value = "{KEY}"\nother = value\nauth_key = other', [KEY]),
        (f'head = "{KEY[:8]}"\ntail = "{KEY[8:]}"\npassphrase = head + tail', [KEY[:8], KEY[8:]]),
        (f"conn:\n  access_key: {KEY}\n", [KEY]),
        (f"signingKey => '{KEY}'", [KEY]),
        (f'a = b\nb = a\njwt = a\na = "{KEY}"', [KEY]),
        (f'title = "{KEY}"', []),
        ('pwd = "changeme"', []),
        ('pwd = "${PASSWORD_FROM_ENV}"', []),
        ("the key: something to remember", []),
        ("pass: on", []),
        ("ratio = 3 : 4", []),
    ],
)
def test_lexer_finds_literals_of_sensitive_names(text, found):
    extra = [text[s:e] for kind, s, e, *_ in S.spans(text) if kind == "literal"]
    assert extra == found


def test_base_spans_and_digest(spark, odd):
    texts = [
        "token = abcdef, Password: 'x9' api-key secret=\"aaaaaa", "APIKEY:zzzzzz== AKIA" + "A" * 20,
        "AKIAABC AKIAAKIA" + "B" * 16, "é" * 7 + "deadbeef" * 4 + " token:" + "f" * 30, "paſſword=abcdefg",
    ]
    docs = ODD + [(100 + i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("secrets", F.lit(1))
    rows = S.scan(df).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = [(s["start"], s["kind"], s["end"]) for s in r["secrets"] if s["base"]]
        assert base == [(a, k, e) for a, _, k, e in secret_base(r["text"])]


def test_masking(spark):
    text = f"a token={KEY}deadbeefdeadbeefdeadbeefdeadbeef b\nuser_pwd = '{KEY}'"
    df = S.scan(spark.createDataFrame([(text,), ("plain",), (None,)], "text string"))
    got = [r[0] for r in df.select(S.mask("text", "secrets")).collect()]
    assert got == ["a [SECRET] b\nuser_pwd = '[SECRET]'", "plain", None]


HEX32 = "0123456789abcdef" * 2


@pytest.mark.parametrize(
    "text, masked",
    [
        ('password = "hunter22!x#y9"', '[SECRET]"'),
        (f'signing_key = "{HEX32}.Zk8!qP2v"', 'signing_key = "[SECRET]"'),
        (f'auth_key = "Zk8!qP2v:{HEX32}"', 'auth_key = "[SECRET]"'),
        ("password: hunter22!x#y9\n", "[SECRET]\n"),
        ("see ?a=1&token=abcdef99!x~z|q end", "see ?a=1&[SECRET] end"),
        ('the password = "correct horse, battery!" works', 'the [SECRET]" works'),
        ('secret = "abcdef\\"tail!", next', '[SECRET]", next'),
        ("secret = 'abcdef!unclosed\nmore", "[SECRET]\nmore"),
        ("f(token=abcdef99, x)", "f([SECRET], x)"),
        (f'title = "{HEX32}.part"', 'title = "[SECRET].part"'),
    ],
)
def test_no_character_of_a_value_survives(spark, text, masked):
    df = S.scan(spark.createDataFrame([(text,)], "text string"))
    assert df.select(S.mask("text", "secrets")).first()[0] == masked


LONG = "Zk8!qP2vLm" * 500  # 5,000 characters


@pytest.mark.parametrize(
    "text, value",
    [
        (f'signing_key = "{LONG}"', LONG),
        (f"signing_key: {LONG}\n", LONG),
        ('signing_key          =          "Zk8!qP2vLm"', "Zk8!qP2vLm"),
        (f"{' ' * 300}signing_key: Zk8!qP2vLm", "Zk8!qP2vLm"),
        (f"{'export   ' * 6}SIGNING_KEY=Zk8!qP2vLm", "Zk8!qP2vLm"),
        (f"export {' ' * 20}SIGNING_KEY=Zk8!qP2vLm", "Zk8!qP2vLm"),
        (f'{"part." * 20}{"long_" * 30}signing_key = "Zk8!qP2vLm"', "Zk8!qP2vLm"),
        (f'a = "Zk8!qP2vLm"\nauth_key = ""{" " * 20}+{" " * 20}a', "Zk8!qP2vLm"),
    ],
)
def test_nothing_is_too_long_for_the_lexer(text, value):
    assert [text[s:e] for kind, s, e, *_ in S.spans(text) if kind == "literal"] == [value]


@pytest.mark.parametrize(
    "unit",
    ["key=", "key = ", "key='a\" ", 'key="<', "key", "key.", "key" + " " * 50, '"key', "- ", "\\", "{{", "token=abcdef!"],
)
def test_long_texts_are_lexed_in_linear_time(unit):
    started = time.process_time()
    S.spans("key: " + unit * (400_000 // len(unit)))
    assert time.process_time() - started < 20


def test_query_digest(spark, tmp_path):
    docs = [(1, "token = abcdef99"), (2, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r["doc_id"]: r for r in queries.QUERIES["op5_secret_scan"](spark, str(tmp_path)).collect()}
    assert rows[1]["base_sha256"] == sha("assign:0:16") and rows[1]["spans"] == "assign:0:16"
    assert (rows[2]["n_assign"], rows[2]["base_sha256"], rows[2]["spans"]) == (0, sha(""), "")


def test_empty(empty):
    assert S.scan(empty).count() == 0
