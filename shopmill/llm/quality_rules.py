"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target against the raw corpus.

Two multinomials over hashed one- and two-word features are counted, one over trusted documents and
one over every document. A text's score is the mean over its features of
``log p(feature | trusted) - log p(feature | corpus)``, so length does not matter; a text is kept when
its score reaches a fixed threshold. Scores are sums of whole micro-nats, hence equal on every run.

Everything is built-in expressions. The model is one array of ``2 * buckets`` numbers, which bounds
what travels to the tasks whatever the corpus holds.

Defined cases: a NULL text counts as empty, an empty or blank text has no feature and score 0.0 (the
base rules reject it anyway). Repeated rows count as often as they occur. A NULL id in either
table matches nothing. Without any trusted document, or on an empty corpus, every score is 0.0. Other
columns of the inputs are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmill.llm.common import SPACE, let, text_of, words_of
from shopmill.operators.scale import durable

BUCKETS = 1 << 13
THRESHOLD = -0.1
SMOOTHING = 1.0
MICRO = 1_000_000


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _features(hashes: Column, buckets: int) -> Column:
    """Bucket of each word, then of each pair of neighbours in the second half of the range."""
    mask = F.lit(buckets - 1).cast("long")
    single = F.transform(hashes, lambda h: h.bitwiseAND(mask))
    pairs = F.transform(
        F.slice(hashes, 2, F.greatest(F.size(hashes), F.lit(1))),
        lambda h, i: F.xxhash64(F.get(hashes, i), h).bitwiseAND(mask) + buckets,
    )
    return F.concat(single, pairs)


def feature_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n`` over all documents; the map side sums first, so at most ``2 * buckets`` rows a task."""
    features = let(_hashes(words_of(text_of(text))), lambda h: _features(h, buckets))
    return docs.select(F.explode(features).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n"))


def fit(
    docs: DataFrame,
    trusted: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    buckets: int = BUCKETS,
    smoothing: float = SMOOTHING,
) -> DataFrame:
    """The model: ``bucket, ratio`` (micro-nats, long) for every bucket. ``trusted`` names ids in ``key``.

    ``buckets`` is a power of two. The table is written once and read back.
    """
    ids = trusted.select(key).filter(F.col(key).isNotNull()).distinct()
    good = docs.filter(F.col(key).isNotNull()).select(key, text)
    good = good.join(ids.hint("shuffle_hash"), key, "left_semi")
    raw = feature_counts(docs, text, buckets).withColumnRenamed("n", "raw")
    aim = feature_counts(good, text, buckets).withColumnRenamed("n", "aim")
    every = docs.sparkSession.range(2 * buckets).toDF("bucket")
    counts = durable(
        every.join(raw, "bucket", "left").join(aim, "bucket", "left").na.fill(0, ["raw", "aim"])
    )
    totals = counts.agg(F.sum("raw").alias("raw"), F.sum("aim").alias("aim"))  # one row
    total = {c: totals.select(c).scalar() for c in ("raw", "aim")}
    size = float(2 * buckets)

    def log_p(c: str) -> Column:
        return F.log((F.col(c) + smoothing) / (total[c] + smoothing * size))

    ratio = F.when(total["aim"] > 0, F.round(MICRO * (log_p("aim") - log_p("raw")))).otherwise(0.0)
    return durable(counts.select("bucket", ratio.cast("long").alias("ratio")))


def _model_array(model: DataFrame) -> Column:
    """All ratios by bucket as one array: ``2 * buckets`` longs."""
    pairs = F.array_sort(F.collect_list(F.struct("bucket", "ratio")))
    return model.agg(F.transform(pairs, lambda p: p["ratio"]).alias("r")).scalar()


def _repeated(hashes: Column) -> Column:
    """Words inside three-word windows that occur at least twice, each word counted once."""

    def covered(windows: Column, bits: Column) -> Column:
        # Sort (hash, position) packed in one long; equal windows become neighbours.
        packed = F.transform(
            windows, lambda w, i: F.call_function("shiftleft", w, bits).bitwiseOR(i.cast("long"))
        )
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
        order = F.transform(F.sort_array(packed), lambda p: p.bitwiseAND(mask).cast("int"))

        def twice(order: Column) -> Column:
            same = lambda i, j: F.get(windows, i) == F.get(windows, F.get(order, j))
            return F.filter(
                order,
                lambda i, j: F.coalesce(same(i, j - 1), F.lit(False))
                | F.coalesce(same(i, j + 1), F.lit(False)),
            )

        def length(starts: Column) -> Column:
            gaps = F.transform(
                starts, lambda s, j: F.coalesce(F.least(F.get(starts, j + 1) - s, F.lit(3)), F.lit(3))
            )
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

        return let(let(order, lambda o: F.sort_array(twice(o))), length)

    windows = F.transform(
        F.slice(hashes, 3, F.greatest(F.size(hashes), F.lit(1))),
        lambda h, i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), h),
    )
    bits = F.ceil(F.log2(F.size(hashes) + 1)).cast("int")
    return let(
        windows,
        lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(
            covered(w, bits)
        ),
    )


def measures(text: Column) -> Column:
    """Struct of the base counts of a text (NULL is empty) and its word hashes."""
    lines = F.filter(F.split(text, "\n"), lambda s: F.rlike(s, F.lit(f"[^{SPACE[1:-1]}]")))

    def base(hashes: Column) -> Column:
        dup = let(lines, lambda a: (F.size(a) - F.size(F.array_distinct(a))).cast("long"))
        chars = F.char_length(text) - F.regexp_count(text, F.lit(SPACE))
        return F.struct(
            F.size(hashes).cast("long").alias("n_words"),
            chars.cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            dup.alias("n_dup_lines"),
            _repeated(hashes).alias("n_repeat_words"),
            hashes.alias("hashes"),
        )

    return let(_hashes(words_of(text)), base)


def judge(
    docs: DataFrame,
    model: DataFrame,
    text: str = "text",
    buckets: int = BUCKETS,
    threshold: float = THRESHOLD,
    out: str = "quality",
) -> DataFrame:
    """``docs`` with a struct column ``out``: the base counts, ``base_failed``, ``ratio`` (mean log-ratio
    in nats) and ``kept``. A column already named ``out`` is replaced; nothing else changes."""
    ratios = F.col(f"_{out}_ratios")

    def mean(hashes: Column) -> Column:
        total = let(
            ratios,
            lambda r: F.aggregate(
                _features(hashes, buckets), F.lit(0).cast("long"), lambda a, b: a + F.get(r, b.cast("int"))
            ),
        )
        n = 2 * F.size(hashes) - 1
        return F.when(n < 1, F.lit(0.0)).otherwise(total / (n * F.lit(float(MICRO))))

    def verdict(m: Column) -> Column:
        failed = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
        return let(
            F.struct(failed.alias("f"), mean(m["hashes"]).alias("r")),
            lambda v: F.struct(
                *[m[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                v["f"].alias("base_failed"),
                v["r"].alias("ratio"),
                (~v["f"] & (v["r"] >= threshold)).alias("kept"),
            ),
        )

    # One row of 2 * buckets numbers; a subquery may not stand inside a lambda, a column may.
    docs = docs.withColumn(f"_{out}_ratios", _model_array(model))
    judged = docs.withColumn(out, let(text_of(text), lambda t: let(measures(t), verdict)))
    return judged.drop(f"_{out}_ratios")
