"""Toxicity: a subsequence string-kernel support vector machine with Nystroem landmarks.

Strings are the letters of a token (or of a run of single letters, as in ``a b c d``); signs and white space
between them are dropped and digits read as the letters they imitate; a sign marks either end. The kernel counts common subsequences of
three letters, each discounted by the stretch it spans, so gaps and inserted characters lower the similarity only
gradually. Landmarks are toxic strings, chosen by pivoted Cholesky until every toxic string lies within ``RESIDUAL`` of their
span (at least ``landmarks`` of them, if there are so many), and the clean look-alikes that are hardest to tell from them.

Training takes labelled sentences apart into strings, each weighted by the number of distinct sentences of either label
that hold it. A string is taken for toxic when nearly all those sentences are toxic (lower Wilson bound at least one
half), after many different words: copies of one document must neither turn its plain words toxic nor an insult it quotes
clean. A sentence found under both labels counts once under each. Counts are exact and distributed; at
most ``positives`` toxic and ``negatives`` clean strings are fetched. In ``ROUNDS`` rounds the machine then judges all clean
strings of the labelled sentences, and those it gets wrong in most sentences join its training set. Last, its bias is set
on whole labelled documents that no string was taken from (a fifth of them, by checksum of the key).

The machine is linear in kernel features, so it is one weight per three-letter subsequence (``Model.table``): a string's decision
is a sum over its own subsequences, whatever the number of landmarks. A document's score follows its most toxic string;
each task judges the distinct tokens of a chunk of texts, so scoring shuffles nothing.

Defined cases: a NULL, empty or wordless text is judged by the bias alone; without toxic strings in training so
is every text; rows are scored each, repeated ones alike; a NULL key is kept and not used in training.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopmill.llm.common import BLANKS, SPACE, text_of
from shopmill.llm.wordtable import chunks, cut
from shopmill.operators.scale import durable

LENGTH, DECAY = 3, 0.6  # letters of a subsequence, discount per letter spanned
POSITIVES, NEGATIVES, LANDMARKS = 300, 4000, 64
LABELLED = 1_000_000  # labelled documents that the machine is fitted on, so many ids and labels travel to the tasks
RESIDUAL = 0.1  # squared distance, of 1, that a toxic string may keep from the landmarks' span
WINDOW = 24  # longer strings are judged by windows of so many letters, at every place that a landmark can take
ROUNDS, HARDEST = 3, 1500  # rounds of looking for misjudged clean strings, and how many join in each
FLOOR = -1.5  # bias of a machine without toxic strings
RIDGE = 1e-4
MOST = 0.05  # largest weight of one clean string, as a share of all clean documents
FALSE_COST = 2.0  # a clean document called toxic, against a toxic one missed (both as shares)
SHARPNESS = 3.0
Z = 2.58

#: A run of at least four single letters with one to three blanks or signs between them.
SPACED = r"(?<!\p{L})(?:\p{L}[\s\p{Punct}&&[^\n]]{1,3}){3,}\p{L}(?!\p{L})"
#: A cheap test that a text can hold such a run at all.
MAYBE_SPACED = r"(?:^|[\s\p{Punct}])\S[\s\p{Punct}]{1,3}\S[\s\p{Punct}]{1,3}\S[\s\p{Punct}]{1,3}\S"
IMITATED = str.maketrans("0134578@$!", "oieastbasi")
SIGNS = "!.,;:?\"'()[]{}#*$%&-_/\\|<> \t"
LETTERS = re.compile(r"[^\W\d_]+")


def spaced_runs(text: Column) -> Column:
    """Runs of single letters in a text."""
    found = F.regexp_extract_all(text, F.lit(SPACED), F.lit(0))
    return F.when(F.rlike(text, F.lit(MAYBE_SPACED)), found).otherwise(F.array().cast("array<string>"))


def letters(token: str) -> str:
    """The letters of a token in lower case; digits and signs inside read as the letters they imitate."""
    token = token.lower().strip(SIGNS)
    if not any(c.isalpha() for c in token):
        return ""
    return "".join(LETTERS.findall(token.translate(IMITATED)))


def ended(string: str) -> str:
    """The string between signs for its begin and end, so that its subsequences tell a stem from the end of a
    longer word; nothing for a string too short for the kernel."""
    return f"^{string}$" if len(string) >= LENGTH else ""


def windows(string: str, longest: int = WINDOW // 2) -> list[str]:
    """The string itself, or windows of a long one such that each stretch of ``longest`` letters is whole in one."""
    if len(string) <= WINDOW:
        return [string]
    step = max(1, WINDOW - longest + 1)
    return [string[i : i + WINDOW] for i in range(0, len(string) - WINDOW + step, step)]


def _codes(strings: list[str], width: int, pad: int) -> np.ndarray:
    out = np.full((len(strings), width), pad, dtype=np.int32)
    for i, s in enumerate(strings):
        out[i, : len(s)] = [ord(c) for c in s]
    return out


def _raw_kernel(a: np.ndarray, b: np.ndarray, n: int, decay: float) -> np.ndarray:
    """Subsequence kernel of broadcast code arrays ``a`` (..., la) and ``b`` (..., lb); negative codes never match."""
    shape = np.broadcast_shapes(a.shape[:-1], b.shape[:-1])
    lb = b.shape[-1]
    steps = np.arange(lb)
    spread = np.where(steps[None, :] >= steps[:, None], decay ** (steps[None, :] - steps[:, None] + 0.0), 0.0)
    spread = spread.astype(np.float32)
    # prefix[i][..., j]: weight of i-letter subsequences of a's read part and of b[: j + 1], discounted to their ends.
    prefix = [np.zeros((*shape, lb), dtype=np.float32) for _ in range(n - 1)]
    total = np.zeros(shape, dtype=np.float32)
    for i in range(a.shape[-1]):
        same = (a[..., i, None] == b) & (b >= 0)
        new = []
        below = None
        for level in range(n - 1):
            if level == 0:
                gain = same * np.float32(decay * decay)
            else:
                gain = np.zeros((*shape, lb), dtype=np.float32)
                gain[..., 1:] = same[..., 1:] * below[..., :-1] * np.float32(decay * decay)
            new.append(gain @ spread)
            below = prefix[level]
        total += (same[..., 1:] * prefix[-1][..., :-1]).sum(axis=-1) * np.float32(decay * decay)
        for level in range(n - 1):
            prefix[level] = prefix[level] * np.float32(decay) + new[level]
    return total


def kernel(strings: list[str], others: list[str], n: int = LENGTH, decay: float = DECAY, block: int | None = None) -> np.ndarray:
    """Normalised subsequence kernel, 0 to 1; 0 for strings of fewer than ``n`` letters."""
    block = block or max(1, 16_384 // max(1, len(others)))  # a fixed number of pairs at a time
    out = np.zeros((len(strings), len(others)), dtype=np.float32)
    if not strings or not others:
        return out
    b = _codes(others, max(map(len, others)), -2)
    own_b = np.sqrt(_raw_kernel(b, b, n, decay))
    order = sorted(range(len(strings)), key=lambda i: len(strings[i]))
    for start in range(0, len(order), block):
        part = order[start : start + block]
        width = len(strings[part[-1]])
        if width < n:
            continue
        a = _codes([strings[i] for i in part], width, -1)
        own_a = np.sqrt(_raw_kernel(a, np.where(a < 0, -2, a), n, decay))
        raw = _raw_kernel(a[:, None, :], b[None, :, :], n, decay)
        scale = own_a[:, None] * own_b[None, :]
        out[part] = np.divide(raw, scale, out=np.zeros_like(raw), where=scale > 0)
    return out


@cache
def _places(size: int) -> tuple[np.ndarray, np.ndarray]:
    """All subsequences of ``LENGTH`` places of a string, and their discounts."""
    at = np.array(list(combinations(range(size), LENGTH)), dtype=np.int32).reshape(-1, LENGTH)
    return at, (DECAY ** (at[:, -1] - at[:, 0] + 1)).astype(np.float32)


def _numbered(strings: list[str], alphabet: np.ndarray) -> np.ndarray:
    """Letters of strings of one length by their place in the alphabet, from 1; 0 for others."""
    points = np.frombuffer("".join(strings).encode("utf-32-le"), dtype=np.uint32).reshape(len(strings), -1)
    at = np.minimum(np.searchsorted(alphabet, points), len(alphabet) - 1)
    return np.where(alphabet[at] == points, at + 1, 0)


def _keys(letters: np.ndarray, size: int) -> np.ndarray:
    """A number per subsequence of each row."""
    places, _ = _places(letters.shape[1])
    letters = letters.astype(np.int32 if size**LENGTH < 1 << 31 else np.int64)
    key = letters[:, places[:, 0]]
    for i in range(1, LENGTH):
        key = key * size + letters[:, places[:, i]]
    return key


class Model(NamedTuple):
    landmarks: list[str]
    weights: np.ndarray  # by landmark, the Nystroem map included
    bias: float

    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Letters of the landmarks, and the machine's weight of each of their subsequences, by ascending number."""
        alphabet = np.unique(np.frombuffer("".join(self.landmarks).encode("utf-32-le"), dtype=np.uint32))
        total: dict[int, float] = {}
        for landmark, weight in zip(self.landmarks, self.weights):
            keys, own = np.unique(_keys(_numbered([landmark], alphabet), len(alphabet) + 1)[0], return_inverse=True)
            counted = np.bincount(own, _places(len(landmark))[1])
            counted /= np.sqrt((counted**2).sum())
            for key, value in zip(keys.tolist(), counted.tolist()):
                total[key] = total.get(key, 0.0) + value * float(weight)
        keys = np.array(sorted(total), dtype=np.int64)
        return alphabet, keys, np.array([total[k] for k in keys.tolist()], dtype=np.float64)

    def decide(self, strings: list[str]) -> np.ndarray:
        """Decision value of each string; the most toxic window of a long one counts."""
        return decisions(strings, self.table(), max(map(len, self.landmarks), default=0), self.bias)


def decisions(strings: list[str], table: tuple, longest: int, bias: float) -> np.ndarray:
    alphabet, known, weights = table
    values = np.full(len(strings), bias)
    if not len(known) or not strings:
        return values
    size = len(alphabet) + 1
    dense = None
    weights = weights.astype(np.float32)
    if size**LENGTH <= 1 << 22:  # the same numbers, looked up by place and not by search
        dense = np.zeros(size**LENGTH, dtype=np.float32)
        dense[known] = weights
    by_length: dict[int, list[tuple[int, str]]] = {}
    for i, s in enumerate(strings):
        for w in windows(ended(s), longest):
            if w:
                by_length.setdefault(len(w), []).append((i, w))
    best = np.full(len(strings), -np.inf)
    for length, own in by_length.items():
        discount = _places(length)[1]
        block = max(1, (1 << 20) // len(discount))
        for start in range(0, len(own), block):
            part = own[start : start + block]
            texts = [w for _, w in part]
            key = _keys(_numbered(texts, alphabet), size)
            if dense is None:
                at = np.minimum(np.searchsorted(known, key), len(known) - 1)
                found = np.where(known[at] == key, weights[at], 0.0)
            else:
                found = dense[key]
            points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.int32).reshape(len(texts), -1)
            norm = np.sqrt(_raw_kernel(points, points, LENGTH, DECAY))
            value = found @ discount / np.maximum(norm, 1e-12) + bias
            np.maximum.at(best, [i for i, _ in part], value)
    return np.where(np.isfinite(best), best, values)


def cover(strings: list[str], least: int, residual: float = RESIDUAL) -> list[str]:
    """The strings, by pivoted Cholesky, whose span leaves at most ``residual`` of any; ties go to the first."""
    gram = kernel(strings, strings).astype(np.float64)
    left, factors, chosen = gram.diagonal().copy(), np.zeros(gram.shape), []
    while len(chosen) < len(strings):
        pivot = int(np.argmax(left))
        if left[pivot] <= (1e-6 if len(chosen) < least else residual):
            break
        k = len(chosen)
        factors[:, k] = (gram[:, pivot] - factors[:, :k] @ factors[pivot, :k]) / np.sqrt(left[pivot])
        left -= factors[:, k] ** 2
        left[pivot] = 0.0
        chosen.append(pivot)
    return [strings[i] for i in sorted(chosen)]


def _machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray, steps: int = 30) -> tuple[np.ndarray, float]:
    """Weights and bias of least squared hinge loss with a ridge, by Newton steps over the rows inside the margin."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-9
    w = np.zeros(x.shape[1])
    loss = lambda v: float((cost * np.maximum(0.0, 1 - y * (x @ v)) ** 2).sum() + (ridge * v * v).sum())
    for _ in range(steps):
        inside = y * (x @ w) < 1
        rows, c = x[inside], cost[inside, None]
        target = np.linalg.solve(rows.T @ (c * rows) + np.diag(ridge), rows.T @ (c[:, 0] * y[inside]))
        step, now = 1.0, loss(w)
        while loss(w + step * (target - w)) > now and step > 1e-4:
            step /= 2
        if step <= 1e-4 or now - loss(w + step * (target - w)) <= 1e-9 * now:
            break
        w = w + step * (target - w)
    return w[:-1], float(w[-1])


def train(
    toxic: dict[str, float] | list[str], clean: dict[str, float] | list[str], landmarks: int = LANDMARKS
) -> Model:
    """Fit the machine to toxic strings (most telling first) and clean ones, with the weight of each or all alike."""

    def weighted(strings: dict[str, float] | list[str], alike: float) -> dict[str, float]:
        found: dict[str, float] = {}
        for s in strings:
            for w in windows(ended(s)):
                if w:
                    found[w] = max(found.get(w, 0.0), strings[s] if isinstance(strings, dict) else alike)
        return found

    bad = weighted(toxic, 1 / max(len(toxic), 1))
    good = {s: c for s, c in weighted(clean, 1 / max(len(clean), 1)).items() if s not in bad}
    if not bad:
        return Model([], np.zeros(0, dtype=np.float32), FLOOR)
    toxic, clean = list(bad), list(good)
    covering = cover(toxic, landmarks)
    near = kernel(clean, covering)  # of the clean strings, the look-alikes come as landmarks too
    most = max(landmarks, len(covering))
    alike = [clean[i] for i in np.argsort(-near.max(axis=1), kind="stable")[:most]] if len(clean) else []
    marks = covering + alike
    gram = kernel(marks, marks).astype(np.float64)
    values, vectors = np.linalg.eigh(gram)
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T
    near = np.concatenate([near, kernel(clean, alike)], axis=1)
    x = np.concatenate([kernel(toxic, marks), near]).astype(np.float64) @ root
    y = np.concatenate([np.ones(len(toxic)), -np.ones(len(clean))])
    w, b = _machine(x, y, np.array([*bad.values(), *good.values()]))
    return Model(marks, root @ w, b)


def _known(labels: DataFrame, key: str, label: str, most: int = LABELLED) -> DataFrame:
    """``key, _y``: one label for each id; contradicting ones are toxic. Of more than ``most`` ids, those of least
    hash, so that the table may travel to every task. Written once."""
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).select(key, F.col(label).alias("_y"))
    known = durable(known.groupBy(key).agg(F.max("_y").alias("_y")))
    share = 0.95 * most / max(known.count(), 1)
    if share >= 0.95:
        return known
    return known.filter(F.pmod(F.xxhash64(F.lit("known"), key), F.lit(1 << 20)) < int(share * (1 << 20)))


def _apart(key: str) -> Column:
    """Whether a document is kept for setting the bias."""
    return F.pmod(F.xxhash64(F.lit("bias"), F.col(key).cast("string")), F.lit(5)) == 0


def string_counts(docs: DataFrame, known: DataFrame, key: str, text: str) -> DataFrame:
    """``w, t, c, varied``: toxic and clean sentences that hold each word, and the different words before it
    in toxic ones. Written once."""
    texts = docs.select(key, text_of(text).alias("_text")).join(F.broadcast(known), key)
    texts = texts.select("_y", F.explode(F.split("_text", r"[.!?\n]+")).alias("_s"))
    sentences = texts.select("_y", F.btrim("_s", F.lit(BLANKS)).alias("_s")).filter("_s <> ''").distinct()
    words = sentences.select("_y", F.split("_s", f"{SPACE}+").alias("_w"))
    pairs = F.transform(
        "_w",
        lambda w, i: F.struct(
            F.btrim(F.lower(w), F.lit(SIGNS)).alias("w"), F.coalesce(F.get("_w", i - 1), F.lit("")).alias("before")
        ),
    )
    words = words.select("_y", pairs.alias("_p"))
    # Each word of a sentence once, without the word before; of toxic sentences also each pair, which counts no sentence.
    once = F.transform(
        F.array_distinct(F.col("_p")["w"]),
        lambda w: F.struct(w.alias("w"), F.lit(None).cast("string").alias("before")),
    )
    words = words.select(
        "_y", F.explode(F.when(F.col("_y") == 1, F.concat(once, F.array_distinct("_p"))).otherwise(once)).alias("p")
    )
    held = F.col("before").isNull()
    counts = (
        words.select("_y", "p.*")
        .filter("w <> ''")
        .groupBy("w", "before")
        .agg(
            F.sum(F.when(held & (F.col("_y") == 1), 1).otherwise(0)).alias("t"),
            F.sum(F.when(held & (F.col("_y") == 0), 1).otherwise(0)).alias("c"),
        )
        .groupBy("w")
        .agg(F.sum("t").alias("t"), F.sum("c").alias("c"), F.count("before").alias("varied"))
    )
    return durable(counts)


def telling_strings(counts: DataFrame, positives: int) -> dict[str, int]:
    """Toxic words, most telling first, at most so many, with the toxic sentences that hold them."""
    n, p = F.col("t") + F.col("c"), F.col("t") / (F.col("t") + F.col("c"))
    low = (p + Z * Z / (2 * n) - Z * F.sqrt(p * (1 - p) / n + Z * Z / (4 * n * n))) / (1 + Z * Z / n)
    telling = counts.filter((F.col("t") > 0) & (F.length("w") >= LENGTH) & (F.col("varied") * 4 >= F.col("t")))
    telling = telling.withColumn("low", low).filter("low >= 0.5")
    return {r["w"]: r["t"] for r in telling.orderBy(F.desc("t"), "w").limit(positives).collect()}


def clean_strings(counts: DataFrame) -> DataFrame:
    return counts.filter((F.col("c") > 0) & (F.col("t") <= F.col("c")) & (F.length("w") >= LENGTH)).select("w", "c")


def hardest(clean: DataFrame, model: Model, most: int) -> dict[str, int]:
    """The clean words inside the machine's margin that weigh most, of all there are."""
    shared = clean.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, longest = shared.value.table(), max(map(len, shared.value.landmarks), default=0)
        for batch in batches:
            value = decisions([letters(w) for w in batch["w"]], table, longest, shared.value.bias)
            yield batch.assign(lost=batch["c"] * (value + 1))[value > -1]

    lost = clean.mapInPandas(judge, "w string, c long, lost double")
    return {r["w"]: r["c"] for r in lost.orderBy(F.desc("lost"), "w").limit(most).collect()}


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    labelled: int = LABELLED,
) -> Model:
    """The machine learnt from at most ``labelled`` labelled documents, its bias set on a fifth of them that gave no string."""
    known = _known(labels, key, label, labelled)
    counts = string_counts(docs.filter(~_apart(key)), known, key, text)
    toxic = telling_strings(counts, positives)
    plain = clean_strings(counts)
    common = plain.orderBy(F.desc("c"), "w").limit(negatives // 2).collect()
    other = plain.orderBy(F.xxhash64("w"), "w").limit(negatives // 2).collect()
    clean = {r["w"]: r["c"] for r in common + other}
    bad, good = (known.filter(F.col("_y") == y).count() for y in (1, 0))

    def spelled(counted: dict[str, int], total: int, most: float) -> dict[str, float]:
        found: dict[str, int] = {}
        for w, n in counted.items():
            found[letters(w)] = found.get(letters(w), 0) + n
        return {s: min(n / max(total, 1), most) for s, n in found.items()}

    model = train(spelled(toxic, bad, 1.0), spelled(clean, good, MOST))
    for _ in range(ROUNDS if model.landmarks else 0):
        more = {w: n for w, n in hardest(plain, model, HARDEST).items() if w not in clean}
        if not more:
            break
        clean |= more
        model = train(spelled(toxic, bad, 1.0), spelled(clean, good, MOST))
    return calibrated(model, docs.filter(_apart(key)), known, key, text)


def calibrated(model: Model, docs: DataFrame, known: DataFrame, key: str, text: str) -> Model:
    """The machine with the bias that costs least on labelled documents (``FALSE_COST``)."""
    if not model.landmarks:
        return model
    level = F.floor(F.col("_decision") * 100).cast("int").alias("level")
    judged = decided(docs.select(key, text), model, text).join(F.broadcast(known), key).groupBy(level)
    levels = judged.agg(F.count_if(F.col("_y") == 1).alias("bad"), F.count_if(F.col("_y") == 0).alias("good"))
    rows = sorted(tuple(r) for r in levels.collect())  # decisions are bounded: a few hundred levels
    bad, good = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not bad or not good:
        return model
    missed, called, costs = 0, good, []
    for low, b, g in rows:  # with a threshold at this level's lower end
        costs.append((missed / bad + FALSE_COST * called / good, low))
        missed, called = missed + b, called - g
    costs.append((missed / bad, rows[-1][0] + 1))
    least = min(c for c, _ in costs)
    best = [low for c, low in costs if c <= least + 1e-12]
    # Between the last level below the threshold and the one above, the middle.
    below = max((r[0] for r in rows if r[0] < best[0]), default=best[0] - 1) + 1
    return model._replace(bias=model.bias - (below + best[-1]) / 200)


def decided(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with the decision value of each row's most toxic string (``_decision``)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # landmarks and weights, a fixed number
    kept = [f for f in docs.schema.fields if f.name != "_decision"]
    row_type = T.StructType(kept)
    whole = text_of(text)
    rows = docs.select(F.struct(*[F.col(f.name) for f in kept]).alias("_row"), whole.alias("_text"), spaced_runs(whole).alias("_spaced"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        table, longest = model.table(), max(map(len, model.landmarks), default=0)

        def values(strings: list[str]) -> np.ndarray:
            """Decisions of strings, each distinct one judged once."""
            number: dict[str, int] = {}
            own = np.array([number.setdefault(s, len(number)) for s in strings], dtype=np.int64)
            return decisions(list(number), table, longest, model.bias)[own] if len(own) else np.zeros(0)

        for batch in batches:
            for part in chunks(batch, "_text"):
                best = np.full(part.num_rows, model.bias)
                words = cut(part.column("_text"))
                codes, distinct = words.codes()
                pair = np.unique(words.text_of() * max(len(distinct), 1) + codes)
                value = values([letters(w.decode()) for w in distinct.to_pylist()])
                if len(value):
                    np.maximum.at(best, pair // len(value), value[pair % len(value)])
                runs = part.column("_spaced")
                at = np.repeat(np.arange(len(runs)), runs.value_lengths().to_numpy(zero_copy_only=False))
                np.maximum.at(best, at, values([letters(w) for w in runs.flatten().to_pylist()]))
                yield pa.RecordBatch.from_arrays([part.column("_row"), pa.array(best)], names=["_row", "_decision"])

    done = rows.mapInArrow(judge, T.StructType().add("_row", row_type).add("_decision", "double"))
    return done.select("_row.*", "_decision")


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score`` (0 to 1) for every row of ``docs``."""
    judged = decided(docs.select(F.col(key), F.col(text)), model, text)
    return judged.select(key, (F.lit(1.0) / (F.lit(1.0) + F.exp(-SHARPNESS * F.col("_decision")))).alias("score"))
