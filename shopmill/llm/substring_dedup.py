"""Passages that repeat across documents, by super-k-mers.

A window is ``window`` consecutive words of one text. Its minimiser is the least hash of its ``M``-word pieces; equal
windows have equal minimisers. Consecutive windows with one minimiser travel as one packed string (the words from the first
window's first to the last window's last) to the minimiser's bucket, where equal strings fold, strings are cut into
windows again and sorting brings equal windows together. So each window's least document id is known exactly, and
a window of a document with a larger id is a repeat.

* A stretch whose minimiser stands in the rows of one id only cannot hold a repeat. Spark counts minimisers first, on short rows
  without text, so only the stretches that may repeat are packed and sent.
* A bucket is read by one task, in the order of a sort, and holds at most ``hot`` stretches, copies counted.
* Larger buckets (copies and passages of very many documents) are not compared in one task: equal strings fold before
  the shuffle, distinct ones are cut into windows, named by 128-bit hashes, which Spark groups; what is found of a string goes
  back to its occurrences by the string's hash, one row a string, so a hot string's occurrences can be split.
* Texts move once: both joins of the texts use one exchange.

Defined cases: a NULL, empty or blank text, and one of fewer words than a window, loses nothing; windows are judged on the
input, overlaps are removed once; rows of one id never remove from each other, also when their texts differ; a row
without an id neither loses nor counts as smaller; equal rows give equal results; every column is kept, one named like ``out``
is replaced; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopmill.llm.common import text_of
from shopmill.llm.wordtable import Words, chunks, cut
from shopmill.operators.scale import durable

WINDOW = 50
M = 5  # words of a piece
LONGEST = 64  # windows in one packed string; longer stretches of one minimiser are cut
HOT = 4096
SALTS = 16

RESULT = T.StructType().add("n_words", "long").add("n_removed", "long").add("kept", "string")


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads neighbours apart."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def minimisers(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of the windows, and the least hash of the pieces of each."""
    n, m = len(words), min(M, window)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    codes, distinct = words.codes()
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()], dtype=np.uint64)[codes]
    piece = hashes[: n - m + 1].copy()
    for i in range(1, m):
        piece = _mixed(piece) + hashes[i : n - m + 1 + i]
    least, span = _mixed(piece), 1
    wanted = window - m + 1
    while 2 * span <= wanted:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < wanted:
        least = np.minimum(least[: len(least) - (wanted - span)], least[wanted - span :])
    last = np.repeat(words.first[1:], np.diff(words.first))[: len(least)] - window
    whole = np.flatnonzero(np.arange(len(least)) <= last)
    return whole, least[whole]


def superkmers(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of windows and minimiser of every stretch of windows that share one."""
    at, least = minimisers(words, window)
    if not len(at):
        return at, at, least
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (least[1:] != least[:-1])
    head = np.flatnonzero(new)
    within = np.arange(len(at)) - np.repeat(head, np.diff([*head, len(at)]))
    head = np.flatnonzero(within % LONGEST == 0)
    return at[head], np.diff([*head, len(at)]), least[head]


def packed(words: Words, first: np.ndarray, windows: np.ndarray, window: int) -> list[bytes]:
    """The words of each stretch, joined by spaces."""
    size = np.diff(words.ends) + 1
    spaced = np.concatenate([[0], np.cumsum(size)])
    line = np.full(int(spaced[-1]), 0x20, dtype=np.uint8)
    solid = np.ones(len(line), dtype=bool)
    solid[spaced[1:] - 1] = False
    line[solid] = words.data
    line = line.tobytes()
    return [line[a:b] for a, b in zip(spaced[first].tolist(), (spaced[first + windows + window - 1] - 1).tolist())]


def _name(string: bytes) -> bytes:
    return xxhash.xxh3_128_digest(string)


def _windows(string: bytes, window: int) -> list[bytes]:
    """Every window of a packed string."""
    edges = [-1, *np.flatnonzero(np.frombuffer(string, np.uint8) == 0x20).tolist(), len(string)]
    return [string[a + 1 : b] for a, b in zip(edges, edges[window:])]


def _least(strings: dict[bytes, int], window: int) -> dict[bytes, list[int]]:
    """Least ids of the windows of each distinct string of a bucket, from the least id of each string."""
    cut_up = {s: _windows(s, window) for s in strings}
    listed = sorted((w, strings[s]) for s, ws in cut_up.items() for w in ws)
    least = {w: next(same)[1] for w, same in groupby(listed, key=lambda x: x[0])}
    return {s: [least[w] for w in ws] for s, ws in cut_up.items()}


def _bucket(rows: list[tuple], window: int) -> Iterator[tuple[int, int, list[int]]]:
    """``_a, _b, starts`` of the repeats among a bucket's stretches (packed string, _a, _b, id, first word)."""
    strings: dict[bytes, int] = {}
    for string, _, _, i, _ in rows:
        strings[string] = min(i, strings.get(string, i))
    if len(strings) == 1:
        lows = {s: [low] * (s.count(b" ") + 2 - window) for s, low in strings.items()}
    else:
        lows = _least(strings, window)
    for string, a, b, i, start in rows:
        starts = [start + k for k, low in enumerate(lows[string]) if low < i]
        if starts:
            yield a, b, starts


def _rows(names: list[str], types: list[pa.DataType], columns: list) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


SPOTS = "array<struct<start:int,windows:int,bucket:bigint,crowded:boolean>>"


def repeats(texts: DataFrame, key: str, text: str, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """``_a, _b, starts``: for each row (``_a, _b, _row``) with a repeat, the first words of its windows that
    also begin in a row of smaller ``key``."""
    rows = texts.select("_a", "_b", F.col("_row")[key].cast("long").alias("_id"), text_of_row(text).alias("_text"))
    rows = rows.filter(F.col("_id").isNotNull())

    def spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "_text"):
                words = cut(part.column("_text"))
                first, windows, bucket = superkmers(words, window)
                text = np.searchsorted(words.first, first, side="right") - 1
                own = [part.column(c).take(pa.array(text)) for c in ("_a", "_b", "_id")]
                start = (first - words.first[text]).astype(np.int32)
                types = [*[pa.int64()] * 4, pa.int32(), pa.int32()]
                columns = [*own, bucket.view(np.int64), start, windows.astype(np.int32)]
                yield _rows(["_a", "_b", "_id", "bucket", "start", "windows"], types, columns)

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, ...]]:
        """Columns of the packed stretches of some texts: bucket, crowded, string, _a, _b, id, first word."""
        for batch in batches:
            for part in chunks(batch, "_text"):
                words = cut(part.column("_text"))
                listed = part.column("spots")
                row = np.repeat(np.arange(len(listed)), listed.value_lengths().to_numpy(zero_copy_only=False))
                flat = listed.flatten()
                start, windows = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("start", "windows"))
                strings = packed(words, words.first[row] + start, windows, window)
                own = [part.column(c).take(pa.array(row)).to_pylist() for c in ("_a", "_b", "_id")]
                yield flat.field("bucket").to_pylist(), strings, *own, start.tolist()

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.binary(), *[pa.int64()] * 3, pa.int32()]
        for columns in stretches(batches):
            yield _rows(["bucket", "packed", "_a", "_b", "_id", "start"], types, list(columns))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Equal strings of a chunk as one, with the least and greatest id."""
        for _, strings, _, _, ids, _ in stretches(batches):
            found: dict[bytes, tuple[int, int]] = {}
            for string, i in zip(strings, ids):
                low, high = found.get(string, (i, i))
                found[string] = min(i, low), max(i, high)
            columns = [list(found), [x[0] for x in found.values()], [x[1] for x in found.values()]]
            yield _rows(["packed", "low", "high"], [pa.binary(), pa.int64(), pa.int64()], columns)

    def occur(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.binary(), *[pa.int64()] * 3, pa.int32()]
        for _, strings, a, b, ids, start in stretches(batches):
            yield _rows(["name", "_a", "_b", "_id", "start"], types, [[_name(s) for s in strings], a, b, ids, start])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket; the last bucket of a batch may go on in the next one."""

        def answers(found: list[tuple]) -> pa.RecordBatch:
            columns = [[x[i] for x in found] for i in range(3)]
            return _rows(["_a", "_b", "starts"], [pa.int64(), pa.int64(), pa.list_(pa.int32())], columns)

        current, held = None, []
        for batch in batches:
            done: list[tuple] = []
            for bucket, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if bucket != current:
                    done.extend(_bucket(held, window))
                    current, held = bucket, []
                held.append(row)
            yield answers(done)
        yield answers(list(_bucket(held, window)))

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for string, low, high in zip(*[c.to_pylist() for c in batch.columns]):
                names = [_name(w) for w in _windows(string, window)]
                n = len(names)
                types = [pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.int64()]
                columns = [names, [_name(string)] * n, np.arange(n, dtype=np.int32), [low] * n, [high] * n]
                yield _rows(["w", "name", "at", "low", "high"], types, columns)

    found = rows.mapInArrow(spots, "_a long, _b long, _id long, bucket long, start int, windows int")
    counts = found.groupBy("bucket").agg(F.min("_id").alias("low"), F.max("_id").alias("high"), F.count("*").alias("n"))
    # Written, so that the join meets a plain shuffle on both sides and a hot minimiser's rows can be split.
    counts = durable(counts.filter("low < high").select("bucket", (F.col("n") > hot).alias("crowded")))
    shared = found.join(counts, "bucket").groupBy("_a", "_b")
    shared = shared.agg(F.collect_set(F.struct("start", "windows", "bucket", "crowded")).alias("spots"))

    def of(crowded: bool) -> DataFrame:
        """Texts with their stretches in crowded buckets, or in the others."""
        own = F.filter("spots", lambda s: s["crowded"] == crowded).cast(SPOTS)
        met = texts.join(shared, ["_a", "_b"])
        met = met.select("_a", "_b", F.col("_row")[key].cast("long").alias("_id"), text_of_row(text).alias("_text"), own.alias("spots"))
        return met.filter(F.size("spots") > 0)

    sent = of(False).mapInArrow(send, "bucket long, packed binary, _a long, _b long, _id long, start int")
    calm = sent.repartition("bucket").sortWithinPartitions("bucket")
    calm = calm.mapInArrow(compare, "_a long, _b long, starts array<int>")

    strings = of(True).mapInArrow(fold, "packed binary, low long, high long").groupBy("packed")
    strings = strings.agg(F.min("low").alias("low"), F.max("high").alias("high"))
    pieces = strings.mapInArrow(cut_up, "w binary, name binary, at int, low long, high long")
    least = pieces.groupBy("w").agg(F.min("low").alias("least"), F.max("high").alias("most")).filter("least < most")
    # A window inside a common passage stands in very many strings: salted, it is many keys of the join.
    salt = F.pmod(F.xxhash64("name"), F.lit(SALTS)).alias("salt")
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
    told = pieces.select("w", salt, "name", "at").join(least.select("w", salts, "least"), ["w", "salt"])
    told = told.groupBy("name").agg(F.collect_list(F.struct("at", "least")).alias("lows"))
    crowd = of(True).mapInArrow(occur, "name binary, _a long, _b long, _id long, start int").join(told, "name")
    smaller = F.filter("lows", lambda w: w["least"] < F.col("_id"))
    starts = F.transform(smaller, lambda w: F.col("start") + w["at"])
    crowd = crowd.select("_a", "_b", starts.alias("starts")).filter(F.size("starts") > 0)
    return calm.unionByName(crowd).groupBy("_a", "_b").agg(F.flatten(F.collect_set("starts")).alias("starts"))


def text_of_row(text: str):
    return F.coalesce(F.col("_row")[text].cast("string"), F.lit(""))


def strip_repeats(
    docs: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text", out: str = "repeats", hot: int = HOT
) -> DataFrame:
    """``docs`` with a struct column: ``n_words``, ``n_removed`` and ``kept``, the words joined by one space that
    no window covers which also starts in a row of smaller ``key`` (an integer)."""
    if window < 2:
        raise ValueError("a window has at least two words")
    kept = [f for f in docs.schema.fields if f.name != out]
    # A row is known by its key and text; equal rows share one result.
    marks = [F.xxhash64(F.col(key), text_of(text)).alias("_a"), F.xxhash64(text_of(text), F.col(key)).alias("_b")]
    texts = docs.select(*marks, F.struct(*[F.col(f.name) for f in kept]).alias("_row"))
    joined = texts.join(repeats(texts, key, text, window, hot), ["_a", "_b"], "left").select("_row", "starts")
    row_type = T.StructType(kept)

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = pa.RecordBatch.from_arrays([*batch.columns, batch.column("_row").field(text)], names=["_row", "starts", "_text"])
            for part in chunks(flat, "_text"):
                words = cut(part.column("_text"))
                starts = part.column("starts")
                sizes = starts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                covered = np.zeros(len(words) + 1, dtype=np.int64)
                begin = np.repeat(words.first[:-1], sizes) + starts.flatten().to_numpy(zero_copy_only=False)
                np.add.at(covered, begin, 1)
                np.add.at(covered, begin + window, -1)
                keep = np.cumsum(covered)[:-1] == 0
                total = np.diff(words.first)
                left = np.diff(np.concatenate([[0], np.cumsum(keep)])[words.first])
                columns = [pa.array(total), pa.array(total - left), words.joined(keep)]
                result = pa.StructArray.from_arrays(columns, names=RESULT.names)
                yield pa.RecordBatch.from_arrays([part.column("_row"), result], names=["_row", "_out"])

    done = joined.mapInArrow(strip, T.StructType().add("_row", row_type).add("_out", RESULT))
    return done.select("_row.*", F.col("_out").alias(out))
