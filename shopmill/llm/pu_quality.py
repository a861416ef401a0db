"""Quality classifier by positive-unlabelled learning with the non-negative unbiased risk.

Only trusted positives are labelled; every other training text is an unlabelled mixture. The class prior
(share of positives in the mixture) is estimated by best-bin estimation: a first classifier tells positives from
unlabelled texts, and the least ratio of the two tails above a score, with a confidence margin, bounds the prior.
The final classifier minimises ``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))`` with the logistic loss.

Texts are described by built-in expressions over the whole text (see ``FEATURES``), so scoring is one scan without
Python. Fitting uses at most ``sample`` rows of each kind, those with the least hash of their id.

Defined cases: a NULL text is empty and has all features 0; without any positive or unlabelled training row
every score is 0.5; a NULL id is never used for training; repeated rows get equal scores; other columns are kept.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmill.llm.common import SPACE, let, text_of, words_of

SAMPLE = 10_000
STEPS = 600
SEED = 5

FEATURES = (
    "log_words", "word_length", "symbols", "bars", "marks", "capitals", "digits", "distinct_words",
    "distinct_pairs", "line_length", "dup_lines", "stops",
)


def features(text: Column) -> Column:
    """Array of the features of a text, in the order of ``FEATURES``."""

    def of(hashes: Column) -> Column:
        n = F.size(hashes)
        words = F.greatest(n, F.lit(1)).cast("double")
        chars = F.greatest(F.char_length(text) - F.regexp_count(text, F.lit(SPACE)), F.lit(1)).cast("double")
        pairs = F.transform(
            F.slice(hashes, 2, F.greatest(n, F.lit(1))), lambda h, i: F.xxhash64(F.get(hashes, i), h)
        )
        share = lambda pattern: F.regexp_count(text, F.lit(pattern)) / words

        def by_lines(lines: Column) -> Column:
            count = F.greatest(F.size(lines), F.lit(1)).cast("double")
            values = [
                F.log1p(n.cast("double")),
                F.least(chars / words, F.lit(30.0)),
                share("[#*$%&<>]"),
                share(r"\|"),
                share("!"),
                F.regexp_count(text, F.lit(r"\p{Lu}")) / chars,
                F.regexp_count(text, F.lit("[0-9]")) / chars,
                F.size(F.array_distinct(hashes)) / words,
                F.size(F.array_distinct(pairs)) / F.greatest(n - 1, F.lit(1)).cast("double"),
                F.log1p(words / count),
                F.size(F.array_distinct(lines)) / count,
                F.regexp_count(text, F.lit(r"[.,;:?]")) / words,
            ]
            return F.when(n == 0, F.array(*[F.lit(0.0)] * len(values))).otherwise(F.array(*values))

        return let(F.split(text, "\n"), by_lines)

    return let(F.transform(words_of(text), lambda w: F.xxhash64(w)), of)


class Model(NamedTuple):
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    linear: tuple[float, ...]
    square: tuple[float, ...]
    bias: float
    prior: float


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, x)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def _descend(gradient, size: int, steps: int, rate: float = 0.05) -> np.ndarray:
    """Adam on a full-batch gradient."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, steps: int = STEPS, sure: float = 0.1) -> float:
    """Share of positives among the unlabelled by best-bin estimation; columns end with a constant 1."""
    p_fit, p_test, u_fit, u_test = positive[::2], positive[1::2], unlabelled[::2], unlabelled[1::2]
    if not len(p_test) or not len(u_test):
        return 0.5

    def gradient(w: np.ndarray) -> np.ndarray:
        return (
            -p_fit.T @ _sigmoid(-p_fit @ w) / len(p_fit)
            + u_fit.T @ _sigmoid(u_fit @ w) / len(u_fit)
            + 1e-3 * w
        )

    w = _descend(gradient, positive.shape[1], steps)
    p, u = np.sort(p_test @ w), np.sort(u_test @ w)
    p_tail = 1 - np.arange(len(p)) / len(p)  # share of positives at or above each of their scores
    u_tail = 1 - np.searchsorted(u, p, "left") / len(u)
    margin = np.sqrt(np.log(4 / sure) / 2) * (1 / np.sqrt(len(u)) + 1 / np.sqrt(len(p)))
    best = np.argmin((u_tail + margin) / p_tail)
    return float(np.clip(u_tail[best] / p_tail[best], 0.05, 0.95))


def fit_arrays(positive: np.ndarray, unlabelled: np.ndarray, steps: int = STEPS) -> Model:
    """The model from feature rows of trusted positives and of the mixture."""
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-6

    def design(x: np.ndarray) -> np.ndarray:
        z = np.clip((x - mean) / scale, -6, 6)
        return np.hstack([z, z * z, np.ones((len(z), 1))])

    p, u = design(positive), design(unlabelled)
    prior = estimate_prior(p, u, steps)

    def gradient(w: np.ndarray) -> np.ndarray:
        fp, fu = p @ w, u @ w
        negative = _softplus(fu).mean() - prior * _softplus(fp).mean()
        as_positive = -prior * p.T @ _sigmoid(-fp) / len(p)
        as_negative = u.T @ _sigmoid(fu) / len(u) - prior * p.T @ _sigmoid(fp) / len(p)
        # Non-negative risk: where the estimate of the negative part falls below zero, undo it.
        return (as_positive + as_negative if negative >= 0 else -as_negative) + 1e-4 * w

    w = _descend(gradient, p.shape[1], steps)
    d = len(mean)
    return Model(tuple(mean), tuple(scale), tuple(w[:d]), tuple(w[d : 2 * d]), float(w[-1]), prior)


def fit(
    docs: DataFrame,
    positives: DataFrame,
    allowed: Column,
    key: str = "doc_id",
    text: str = "text",
    sample: int = SAMPLE,
) -> Model | None:
    """``positives`` names trusted ids in ``key``; ``allowed`` is a condition on ``key`` that training rows meet.

    At most ``sample`` positives and ``sample`` unlabelled documents are described and fetched.
    """
    order = [F.xxhash64(F.lit(SEED), key), F.col(key)]

    def least(rows: DataFrame) -> DataFrame:
        ids = rows.select(key).filter(F.col(key).isNotNull() & allowed)
        return ids.distinct().orderBy(*order).limit(sample)

    def described(rows: DataFrame) -> np.ndarray:
        wanted = docs.select(key, text).join(F.broadcast(least(rows)), key, "left_semi")  # at most ``sample`` ids
        found = wanted.select(features(text_of(text)).alias("x")).collect()
        return np.array([r["x"] for r in found], dtype=np.float64).reshape(len(found), len(FEATURES))

    p, u = described(positives), described(docs)
    return fit_arrays(p, u) if len(p) and len(u) else None


def score(docs: DataFrame, model: Model | None, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out``, the probability of good quality. A column already named ``out`` is replaced."""
    if model is None:
        return docs.withColumn(out, F.lit(0.5))

    def probability(x: Column) -> Column:
        total = F.lit(model.bias)
        for i in range(len(FEATURES)):
            z = (F.get(x, F.lit(i)) - model.mean[i]) / model.scale[i]
            z = F.greatest(F.least(z, F.lit(6.0)), F.lit(-6.0))
            total = total + z * model.linear[i] + z * z * model.square[i]
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    return docs.withColumn(out, let(let(text_of(text), features), probability))
