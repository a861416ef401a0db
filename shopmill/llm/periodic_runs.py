"""Runs of periodic words by a dictionary of basic factors.

A run of period ``q`` is a stretch of words, ``q`` apart identical, that neither neighbour extends. For every
power of two ``w``, factors of ``w`` words are named by pairs of names of half the length, one sort per level over the
factors that still occur twice in their text. A factor's successor is its next occurrence; successors at most
``2 w`` away propose a period, and those that continue an arithmetic progression, or the proposal of
the word before, propose nothing new. Each proposal is extended to both sides by comparing names from the longest
factors down, and equal stretches keep their least period.

Nothing is missed: let ``w`` be the least power of two with ``w >= q``. The factor of ``w`` words that begins a run of at
least ``3 q`` words recurs ``q`` words on, as ``q + w < 3 q``. It does not recur earlier: two periods ``p < q`` and ``q`` of
a stretch of at least ``p + q`` words make their greatest common divisor a period, and ``q`` is the least one.

Texts are cut into words once per Arrow batch; all texts of a chunk are named together (names of different texts differ),
so there is no Python loop over texts or words. Memory follows the longest text.

Defined cases: a NULL, empty or blank text has no words and no runs; a text without runs is collapsed to its words
joined by one space; equal rows give equal results; every column of the input is kept, one named like ``out`` is
replaced; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shopmill.llm.wordtable import Words, chunks, cut

LEAST_WORDS = 24
LEAST_PERIODS = 3

RUN = T.StructType().add("start", "long").add("length", "long").add("period", "long")
RESULT = T.StructType().add("n_words", "long").add("runs", T.ArrayType(RUN)).add("collapsed", "string")


def basic_factors(words: Words) -> tuple[list[np.ndarray], list[tuple[np.ndarray, np.ndarray]]]:
    """Names and proposals by level: names of the factors of ``2 ** level`` words by first word (-1 for one that
    occurs once in its text), and the (word, period) pairs that successors propose."""
    n = len(words)
    codes, _ = words.codes()
    text = words.text_of()
    stop = words.first[1:][text]  # where the text of a word ends
    place = np.arange(n)
    key = text * (int(codes.max(initial=0)) + 1) + codes
    names, proposals, width = [], [], 1
    while len(place):
        order = np.argsort(key, kind="stable")
        by_key, at = key[order], place[order]
        again = by_key[1:] == by_key[:-1]
        group = np.concatenate([[0], np.cumsum(~again)])
        twice = np.zeros(len(order), dtype=bool)
        twice[1:] |= again
        twice[:-1] |= again
        name = np.full(n + 1, -1, dtype=np.int32)
        name[at[twice]] = group[twice]
        succeeds = np.zeros(n + 1, dtype=np.int32)
        succeeds[at[:-1][again]] = (at[1:] - at[:-1])[again]
        names.append(name)
        proposals.append(_proposals(succeeds, width))
        place = np.sort(at[twice])
        place = place[place + 2 * width <= stop[place]]
        place = place[name[place + width] >= 0]
        key = name[place].astype(np.int64) * (n + 1) + name[place + width]
        width *= 2
    return names, proposals


def _proposals(succeeds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Heads of arithmetic progressions of one level: words and distances, none that its neighbour or
    predecessor proposes as well."""
    at = np.flatnonzero((succeeds > 0) & (succeeds <= 2 * width))
    period = succeeds[at]
    beside = (at > 0) & (succeeds[at - 1] == period)
    before = (at >= period) & (period <= width) & (succeeds[np.maximum(at - period, 0)] == period)
    head = ~(beside | before)
    return at[head], period[head].astype(np.int64)


def _alike(names: list[np.ndarray], left: np.ndarray, right: np.ndarray, step: int) -> np.ndarray:
    """How many words agree from ``left`` and ``right`` on (step 1), or before them (step -1)."""
    agreed = np.zeros(len(left), dtype=np.int64)
    top = len(names) - 1
    for level in range(top, -1, -1):
        name, width = names[level], 1 << level
        going = np.arange(len(left))
        while len(going):
            shift = agreed[going] if step > 0 else -agreed[going] - width
            a, b = left[going] + shift, right[going] + shift
            inside = (a >= 0) & (b < len(name))
            a, b = np.where(inside, a, len(name) - 1), np.where(inside, b, len(name) - 1)
            equal = inside & (name[a] >= 0) & (name[a] == name[b])
            going = going[equal]
            agreed[going] += width
            if level < top:  # below the longest factors each length fits in once at most
                break
    return agreed


def runs_of(
    words: Words, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (word of the whole chunk), length and least period of every run, by start and period."""
    if least_periods < 3:
        raise ValueError("runs of fewer than three periods need not be proposed")
    names, proposals = basic_factors(words)
    at = np.concatenate([np.zeros(0, np.int64), *[p[0] for p in proposals]])
    period = np.concatenate([np.zeros(0, np.int64), *[p[1] for p in proposals]])
    right = _alike(names, at, at + period, 1)
    left = _alike(names, at, at + period, -1)
    start, length = at - left, left + period + right
    long = length >= np.maximum(least_words, least_periods * period)
    start, length, period = start[long], length[long], period[long]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _judged(texts: pa.Array, least_words: int, least_periods: int) -> pa.Array:
    words = cut(texts)
    start, length, period = runs_of(words, least_words, least_periods)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    keep = np.cumsum(change)[:-1] == 0
    edges = np.searchsorted(start, words.first)  # runs are sorted by start, so those of a text are neighbours
    base = words.first[np.searchsorted(words.first, start, side="right") - 1] if len(start) else start
    fields = [pa.array(c, pa.int64()) for c in (start - base, length, period)]
    runs = pa.StructArray.from_arrays(fields, names=["start", "length", "period"])
    listed = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), runs)
    counts = pa.array(np.diff(words.first), pa.int64())
    return pa.StructArray.from_arrays([counts, listed, words.joined(keep)], names=["n_words", "runs", "collapsed"])


def find_runs(
    docs: DataFrame,
    text: str = "text",
    out: str = "periodic",
    least_words: int = LEAST_WORDS,
    least_periods: int = LEAST_PERIODS,
) -> DataFrame:
    """``docs`` with a struct column: ``n_words``, ``runs`` (start word, length, least period; by start,
    then period) and ``collapsed``, the text's words without those that a run repeats after its first period."""
    kept = [f for f in docs.schema.fields if f.name != out]
    schema = T.StructType([*kept, T.StructField(out, RESULT)])
    names = [f.name for f in kept]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                column = _judged(part.column(text), least_words, least_periods)
                yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], column], names=[*names, out])

    return docs.mapInArrow(work, schema)
