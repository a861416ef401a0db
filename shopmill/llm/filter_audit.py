"""How five document filters interact, in every order, from additive counts of failure masks.

1. One scan of the texts gives each document a mask of the conditions that it fails by itself and two hashes; these short
   rows are written once.
2. Counting-Bloom prepass: every task folds its hashes into sparse counting sketches (``CELLS`` counters a slice, as many
   slices as the number of rows asks for), which add up by slice. A text with a counter of one is unique for certain.
3. Only the texts whose counters all exceed one are read again; they fold by full text to their least id, and texts
   that occur in several rows give (hashes, least id).
4. A document whose text has a smaller least id fails the duplicate filter as well. Masks, with what the labels say, are
   counted per part; everything that is reported follows from at most 32 counts per part and label.

The sketch grows with the rows (``CELLS_PER_ROW`` bytes each). It is sent to the tasks while it is at most
``SENT_BYTES``, which is checked before the join; a larger one is joined by a shuffle on its slice.

Defined cases: a NULL text is empty; texts are equal whatever their id; an id repeated is not smaller than itself, and a row
without an id is no first one and no duplicate; a label of an id holds for all rows of the id, and holds if any of several rows
says so; a NULL part is the part of the empty name; an empty table gives no rows. Only the columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmill.llm.common import text_of
from shopmill.llm.wordtable import chunks, cut
from shopmill.operators.scale import durable

LETTERS = "ABCDE"
CELLS = 1 << 14  # counters of a slice, one byte each
CELLS_PER_ROW = 8
PROBES = 2  # counters of a text
SENT_BYTES = 64 << 20  # largest sketch that travels to every task

_CAPITAL = np.zeros(256, dtype=bool)
_CAPITAL[ord("A") : ord("Z") + 1] = True
_SIGN = np.zeros(256, dtype=bool)
_SIGN[list(b"#$%&*|")] = True


def own_masks(texts: pa.Array) -> np.ndarray:
    """Bits 0 to 3 for the conditions A to D of each text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    words = cut(texts)
    n_words = np.diff(words.first)
    codes, _ = words.codes()
    text = words.text_of()
    distinct = np.unique(text * (int(codes.max(initial=0)) + 1) + codes) // (int(codes.max(initial=0)) + 1)
    n_distinct = np.bincount(distinct, minlength=len(texts))

    def per_text(table: np.ndarray) -> np.ndarray:
        """How many bytes of each text's words the table marks; none of them is white space."""
        total = np.concatenate([[0], np.cumsum(table[words.data])])
        return np.diff(total[words.ends[words.first]])

    points = pc.utf8_length(texts).to_numpy(zero_copy_only=False)
    failed = [
        n_words < 200,
        100 * n_distinct < 50 * n_words,
        100 * per_text(_CAPITAL) > 2 * points,
        per_text(_SIGN) > 0,
    ]
    return sum(f.astype(np.int32) << i for i, f in enumerate(failed))


def facts(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``id, part, mask, h, s``: one short row per document, from one scan of the texts."""
    whole = text_of(text)
    rows = docs.select(
        F.col(key).cast("long").alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.xxhash64(whole).alias("h"),
        F.sha2(whole, 256).alias("s"),
        whole.alias("text"),
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in chunks(batch, "text"):
                mask = pa.array(own_masks(piece.column("text")), pa.int32())
                columns = [piece.column(c) for c in ("id", "part", "h", "s")]
                yield pa.RecordBatch.from_arrays([*columns, mask], names=["id", "part", "h", "s", "mask"])

    return rows.mapInArrow(judge, "id long, part string, h long, s string, mask int")


def slices_for(rows: int) -> int:
    return max(1, -(-rows * CELLS_PER_ROW // CELLS))


def _slice(h: Column, slices: int) -> Column:
    return F.pmod(h, F.lit(slices)).cast("int")


def _cell(h: Column, probe: int) -> Column:
    """A counter's place in its slice; other bits of the hash than those that choose the slice decide."""
    return F.pmod(F.xxhash64(h, F.lit(probe)), F.lit(CELLS)).cast("int")


def sketch(hashes: DataFrame, slices: int) -> DataFrame:
    """``slice, counters``: counting Bloom filters of a column ``h``; counters stop at 2."""
    probes = F.array(*[_cell(F.col("h"), p) for p in range(PROBES)])
    cells = hashes.select(_slice(F.col("h"), slices).alias("slice"), probes.alias("cells"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A sparse sketch per slice: places hit, and how often (2: more than once)."""
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column("slice").to_numpy(zero_copy_only=False).astype(np.int64)
            each = batch.column("cells").flatten().to_numpy(zero_copy_only=False).reshape(len(own), PROBES)
            each = np.sort(each, axis=1)
            new = np.ones(each.shape, dtype=bool)  # a text whose probes meet counts once
            new[:, 1:] = each[:, 1:] != each[:, :-1]
            place, n = np.unique((own[:, None] * CELLS + each)[new], return_counts=True)
            of = place // CELLS
            edges = [0, *(np.flatnonzero(np.diff(of)) + 1).tolist(), len(of)]
            lists = pa.array(edges, pa.int32())
            columns = [
                pa.array(of[edges[:-1]], pa.int32()),
                pa.ListArray.from_arrays(lists, pa.array(place % CELLS, pa.int32())),
                pa.ListArray.from_arrays(lists, pa.array(np.minimum(n, 2), pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["slice", "cells", "counts"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sparse sketches come sorted by slice; one dense sketch is held at a time."""
        current, counters = None, np.zeros(CELLS, dtype=np.int64)

        def dense() -> pa.RecordBatch:
            listed = pa.array([np.minimum(counters, 2).astype(np.int8)], pa.list_(pa.int8()))
            return pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), listed], names=["slice", "counters"])

        for batch in batches:
            for own, cells, counts in zip(*[batch.column(c) for c in ("slice", "cells", "counts")]):
                if own.as_py() != current:
                    if current is not None:
                        yield dense()
                    current, counters = own.as_py(), np.zeros(CELLS, dtype=np.int64)
                at = cells.values.to_numpy(zero_copy_only=False)
                counters[at] = np.minimum(counters[at] + counts.values.to_numpy(zero_copy_only=False), 2)
        if current is not None:
            yield dense()

    sparse = cells.mapInArrow(fold, "slice int, cells array<int>, counts array<int>")
    dealt = sparse.repartition("slice").sortWithinPartitions("slice")
    return dealt.mapInArrow(merge, "slice int, counters array<tinyint>")


def possible_repeats(docs: DataFrame, counted: DataFrame, slices: int) -> DataFrame:
    """Rows of ``docs`` (with a hash ``h``) that the sketch does not clear as unique."""
    if slices * CELLS <= SENT_BYTES:
        counted = F.broadcast(counted)
    joined = docs.withColumn("slice", _slice(F.col("h"), slices)).join(counted, "slice")
    often = [F.element_at("counters", _cell(F.col("h"), p) + 1) > 1 for p in range(PROBES)]
    both = often[0]
    for one in often[1:]:
        both = both & one
    return joined.filter(both).drop("slice", "counters")


def firsts(docs: DataFrame, hashes: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``h, s, first``: least id of every full text that several rows hold, by the text's two hashes."""
    slices = slices_for(hashes.count())
    counted = durable(sketch(hashes.select("h"), slices))
    whole = text_of(text)
    rows = docs.select(F.col(key).cast("long").alias("id"), whole.alias("text"), F.xxhash64(whole).alias("h"))
    folded = possible_repeats(rows, counted, slices).groupBy("text").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    return folded.filter("n > 1").select(F.xxhash64("text").alias("h"), F.sha2("text", 256).alias("s"), "first")


def mask_counts(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source"
) -> DataFrame:
    """``part, mask, n, n_good, n_toxic``: documents by the set of conditions that they fail (bit 0: A)."""
    rows = durable(facts(docs, key, text, part))
    least = firsts(docs, rows, key, text)
    marked = labels.filter((F.col("quality") == 1) | (F.col("toxic") == 1)).groupBy(F.col(key).cast("long").alias("id"))
    marked = marked.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("bad"))
    rows = rows.join(least, ["h", "s"], "left").join(marked, "id", "left")
    again = F.coalesce(F.col("first") < F.col("id"), F.lit(False))
    mask = F.col("mask") + F.when(again, 1 << LETTERS.index("E")).otherwise(0)
    return rows.groupBy("part", mask.alias("mask")).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("good")).alias("n_good"),
        F.count_if(F.col("bad")).alias("n_toxic"),
    )


#: One entry per order and step: (order, step, bit of the filter, bits of the filters before it).
STEPS = [
    ("".join(order), step, 1 << LETTERS.index(order[step - 1]), sum(1 << LETTERS.index(c) for c in order[: step - 1]))
    for order in permutations(LETTERS)
    for step in range(1, len(LETTERS) + 1)
]


def audit(counts: DataFrame) -> DataFrame:
    """All orders and steps of every part, from its mask counts.

    A part is one row that holds its masks; ``shapley`` follows from them as each filter comes first among the k that a
    document fails in 120 / k of the 120 orders.
    """
    entry = F.struct("mask", "n", "n_good", "n_toxic")
    parts = counts.groupBy("part").agg(F.collect_list(entry).alias("masks"))  # at most 32 a part
    steps = F.array(
        *[
            F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("bit"), F.lit(p).alias("before"))
            for o, s, b, p in STEPS
        ]
    )
    rows = parts.select("part", "masks", F.explode(steps).alias("at"))
    bit, before = F.col("at.bit"), F.col("at.before")

    def total(value, wanted) -> Column:
        start = F.lit(0).cast("long")
        return F.aggregate("masks", start, lambda a, m: a + F.when(wanted(m["mask"]), value(m)).otherwise(F.lit(0)).cast("long"))

    n = lambda m: m["n"]
    fails = lambda m: m.bitwiseAND(bit) != 0
    passed = lambda m: m.bitwiseAND(before) == 0
    removed = lambda m: fails(m) & passed(m)
    return rows.select(
        "part",
        "at.filter_order",
        "at.step",
        total(n, lambda m: m.bitwiseAND(bit.bitwiseOR(before)) == 0).alias("kept"),
        total(n, removed).alias("removed"),
        total(n, lambda m: fails(m) & ~passed(m)).alias("redundant"),
        total(n, lambda m: m == bit).alias("unique_fails"),
        total(lambda m: m["n_good"], removed).alias("good_lost"),
        total(lambda m: m["n_toxic"], removed).alias("toxic_lost"),
        total(lambda m: m["n"] * F.lit(120) / F.bit_count(m["mask"]), fails).alias("shapley"),
    )
