"""Training-text pipeline over ``documents``: one stage per operator, each written and read again.

Each stage takes rows with ``doc_id`` and ``text``; other columns are kept under their names, whatever these are. A NULL
text is an empty one and an id may be NULL or repeated: rows are judged by their text. Texts are read whole. An empty table
gives an empty result. What blank texts, ties and repeated rows give stands with each stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmill.llm import bpe, decontamination, near_dedup, quality_rules, secret_scan
from shopmill.llm.common import show_package, table, unused
from shopmill.operators.scale import checkpoint_root


EVIDENCE = 5  # words of a benchmark item from which its occurrence is taken for contamination


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality rules keep: no blank text (too few words); equal texts are judged alike."""
    trusted = table(spark, folder, "labels").filter("quality = 1")
    model = quality_rules.fit(docs, trusted)
    out = unused(docs, "_quality")
    judged = quality_rules.judge(docs, model, out=out)
    return judged.filter(F.col(out)["kept"]).drop(out)


def near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8).

    That of the least id stays, ids that are NULL come last, ties go by the hash of the text; repeated rows leave one;
    blank texts are in no group and stay.
    """
    return near_dedup.keep_one(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no benchmark item of at least ``EVIDENCE`` words within its error budget.

    Blank texts hold none and stay, as does everything when there are no items; equal texts are judged alike.
    """
    items = table(spark, folder, "benchmark")
    out = unused(docs, "_matches")
    marked = decontamination.contamination(docs, items, min_words=EVIDENCE, out=out)
    return marked.filter(F.size(out) == 0).drop(out)


def secret_free(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, every found secret replaced by a sign; ``n_chars`` follows the text.

    Rows without a secret, blank ones among them, come back as they were; a NULL text stays NULL.
    """
    out = unused(docs, "_secrets")
    marked = secret_scan.scan(docs, out=out).withColumn("text", secret_scan.mask("text", out))
    size = F.when(F.size(out) > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return marked.withColumn("n_chars", size).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of each remaining document, its length in tokens and the digest of its decoded text.

    A blank text gets the ids of its blanks, an empty or NULL one none; every row gets its own, repeated rows equal ones.
    """
    path = bpe.vocabulary("word_bpe_49k.json")
    return bpe.encode(docs, path, outputs=("ids_sha256", "decoded_sha256", "ids"))


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_copies),
    ("decontamination", benchmark_free),
    ("secret_scan", secret_free),
    ("bpe", encoded),
]
ORACLE_SQL = None  # several stages are not expressible in SQL; tests/llm holds brute-force versions


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages in order; each result is written to the shared folder and read as the next one's input."""
    show_package(spark)
    docs = table(spark, folder, "documents")
    home = f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES, 1):
        path = f"{home}/{number}-{name}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
