"""BPE encoding and decoding through a table of distinct words.

Tasks split each text into words whose ids do not depend on their neighbours; Spark counts the distinct words
and encodes each of them once, by the tokenizers library. The ids then go back to the places of the words:

* the ``head`` most frequent words (a fixed number of short words, so of bounded size) travel to the tasks
  as a table, and each document becomes a packed sequence of places in that table;
* every other occurrence is a row (document, number among the document's rare words, word), joined with the word
  table by a shuffle and gathered per document;
* a join of the two by document fills the gaps, and decoding looks the ids up in the id-to-piece table of the vocabulary.

So every word occurrence is joined, whatever the number of distinct words. Frequent words never
shuffle, and a hot word lies in the head.

A text whose characters are ASCII or precomposed Latin letters and signs is cut as the tokenizer's own
splitter cuts it, in lower case; composition leaves it as it is. In any other text (other scripts, combining marks, rare
white space, special-token strings) words are stretches between ASCII white space, and the library does the rest inside
each: no rule of the tokenizer reaches over white space.

Defined cases: a NULL text is empty; an empty or blank text has no ids and decodes to the empty text; equal rows
give equal results, once for each row; a NULL key is kept; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmill.llm.common import SPACE, text_of
from shopmill.llm.wordtable import chunks
from shopmill.operators.scale import durable

HEAD = 1 << 19
HEAD_CHARS = 64
RARE = (1 << 24) - 1  # place that stands for a word outside the head
FLUSH = 1_000_000  # distinct words that a task holds before it passes their counts on
WORDS = 1 << 18  # words that a task spells out at once
CHUNK = 4 << 20  # bytes of text that a task cuts into words at once; a longer text is taken whole
#: Outputs of ``encode`` and their types.
SQL = {"ids": "array<int>", "ids_sha256": "string", "decoded": "string", "decoded_sha256": "string"}

#: The tokenizer file's splitting rule (fixed value) for lower-cased Latin text: runs of letters, single digits,
#: contractions, runs of other signs. Letters and digits are listed, as the texts it is used on have no others.
_L, _N = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼½¾"
SPLIT = re.compile(rf"[{_L}]+|[{_N}]|'(?:[stmd]|re|ve|ll)|[^\s{_L}{_N}]+")
#: Anything but ASCII, and letters and signs below U+0180 that composition and lower-casing keep one for one.
UNUSUAL = re.compile(r"[^\x09-\x0D\x20-\x7E¡-įı-ſ]")
BLANK = re.compile(SPACE + "+")


def words_of(text: str) -> list[str]:
    """The words of a text in order; encoding them one by one gives the text's ids."""
    if "<|" in text or UNUSUAL.search(text):
        return [w for w in BLANK.split(text) if w]
    return SPLIT.findall(text.lower())


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file of the installed package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _tokenizer(path: str):
    """The library's tokenizer of a vocabulary file, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


GAP, LETTER, SINGLE, SIGN, ODD = range(5)  # kinds of characters


def _latin() -> np.ndarray:
    """What the characters below U+0180 are by code point, and ``ODD`` for those that are left to ``words_of``."""
    kinds = np.full(0x180, ODD, np.uint8)
    for point in range(0x180):
        c = chr(point)
        if not UNUSUAL.search(c):
            letter, single = re.match(f"[{_L}]", c), re.match(f"[{_N}]", c)
            kinds[point] = GAP if c.isspace() else LETTER if letter else SINGLE if single else SIGN
    return kinds


_KINDS = _latin()
_LOWER = np.array([ord(chr(p).lower()) if k != ODD else p for p, k in enumerate(_KINDS)], np.uint16)
_BYTE_KINDS = np.concatenate([_KINDS[:0x80], np.full(0x80, ODD, np.uint8)])
_BYTE_LOWER = np.concatenate([_LOWER[:0x80], np.arange(0x80, 0x100)]).astype(np.uint8)


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of some texts after the other, as ``words_of`` gives them, and the number of each text's.

    Texts of characters below U+0180 are cut by array operations over their bytes: a word starts where the kind of
    character changes, at every digit, and behind a contraction. The other texts are cut one by one.
    """
    texts = texts.cast(pa.large_string())
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    kind, low = _BYTE_KINDS[raw], _BYTE_LOWER[raw]
    edge = np.zeros(len(raw) + 1, dtype=bool)  # places where a text begins or ends
    edge[offsets] = True
    tails = np.zeros(0, np.int64)
    if (raw >= 0x80).any():  # two bytes a character: both get its kind
        leads = np.flatnonzero((raw[:-1] >= 0xC2) & (raw[:-1] <= 0xC5) & (raw[1:] >= 0x80) & (raw[1:] < 0xC0))
        points = (raw[leads] & 0x1F).astype(np.int64) << 6 | raw[leads + 1] & 0x3F
        tails = leads + 1
        kind[leads] = kind[tails] = _KINDS[points]
        small = _LOWER[points]
        low[leads], low[tails] = 0xC0 | small >> 6, 0x80 | small & 0x3F
    starts = kind != GAP
    starts[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == SINGLE) | edge[1:-1]
    starts[tails] = False
    _contract(low, kind, starts, edge)
    odd = np.flatnonzero(kind == ODD)
    special = np.flatnonzero((raw[:-1] == ord("<")) & (raw[1:] == ord("|")) & ~edge[1:-1])
    others = np.unique(np.searchsorted(offsets, np.concatenate([odd, special]), side="right") - 1)
    solid = kind != GAP
    for i in others:
        solid[offsets[i] : offsets[i + 1]] = starts[offsets[i] : offsets[i + 1]] = False
    sizes = np.diff(np.searchsorted(np.flatnonzero(starts), offsets))
    first = np.append(np.flatnonzero(starts[solid]), np.count_nonzero(solid)).astype(np.int32)
    buffers = [None, pa.py_buffer(first), pa.py_buffer(low[solid])]
    words = pa.Array.from_buffers(pa.string(), len(first) - 1, buffers)
    if len(others):
        apart = [words_of(texts[int(i)].as_py()) for i in others]
        counts = np.array([len(w) for w in apart])
        of = np.concatenate([np.repeat(np.arange(len(sizes)), sizes), np.repeat(others, counts)])
        words = pa.concat_arrays([words, pa.array([w for own in apart for w in own], pa.string())])
        words = words.take(pa.array(np.argsort(of, kind="stable")))
        sizes[others] = counts
    return words, sizes


def _contract(low: np.ndarray, kind: np.ndarray, starts: np.ndarray, edge: np.ndarray) -> None:
    """Move the starts of words to where contractions (an apostrophe that starts a word, and its letters) begin and end."""
    at = np.flatnonzero(starts & (low == ord("'")))
    pad = np.concatenate([low, np.zeros(3, np.uint8)])
    shut = np.concatenate([edge, np.ones(3, dtype=bool)])
    one, two = pad[at + 1], pad[at + 2]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8)) & ~shut[at + 1]
    pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    pair &= ~shut[at + 1] & ~shut[at + 2] & ~short
    starts[at[short | pair] + 1] = False
    behind = np.concatenate([at[short] + 2, at[pair] + 3])
    behind = behind[behind < len(low)]
    starts[behind[kind[behind] == LETTER]] = True


def _lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; then a worker that waits for its next task gives back what Arrow holds for it."""
    yield from batches
    pa.default_memory_pool().release_unused()


def word_table(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``word, n, ids``: every distinct word of the texts, how often it occurs, its ids. Written once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            for part in chunks(batch, "_text", CHUNK):
                seen = cut(part.column("_text"))[0].value_counts()
                own = pa.table({"word": seen.field("values"), "n": seen.field("counts")})
                held = own if held is None else pa.concat_tables([held, own])
                held = held.group_by("word").aggregate([("n", "sum")]).rename_columns({"n_sum": "n"})
                if len(held) > FLUSH:
                    yield from held.select(["word", "n"]).to_batches()
                    held = None
        if held is not None:
            yield from held.select(["word", "n"]).to_batches()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        for batch in batches:
            words = batch.column("word").to_pylist()
            ids = [e.ids for e in tokenizer.encode_batch(words, add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("n"), pa.array(ids, pa.list_(pa.int32()))],
                names=["word", "n", "ids"],
            )

    counted = docs.select(text_of(text).alias("_text")).mapInArrow(lambda b: _lean(count(b)), "word string, n long")
    counted = counted.groupBy("word").agg(F.sum("n").alias("n"))
    return durable(counted.mapInArrow(lambda b: _lean(encode(b)), "word string, n long, ids array<int>"))


def frequent(counted: DataFrame, most: int) -> DataFrame:
    """The rows of greatest count ``n``, at most about ``most``, without sorting them in one task.

    Counts are put into classes of an eighth of a power of two; the sizes of the classes (a few hundred numbers) say which
    fit in whole, and of the first that does not, words of least hash fill what is left.
    """
    level = F.floor(F.log2("n") * 8).cast("int")
    sizes = counted.groupBy(level.alias("level")).agg(F.count("*").alias("size"))
    room, least, share = most, 0, 0.0
    for row in sizes.orderBy(F.desc("level")).collect():
        least = row["level"]
        if row["size"] > room:
            share = room / row["size"]
            break
        room -= row["size"]
    else:
        return counted
    part = F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(share * (1 << 20))
    return counted.filter((level > least) | ((level == least) & part))


def _head(table: DataFrame, head: int) -> pa.Table:
    """The most frequent words with their ids, at most ``head`` words of ``HEAD_CHARS`` characters, by count."""
    short = table.filter(F.char_length("word") <= HEAD_CHARS).select("word", "n", "ids")
    found = frequent(short, head).toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    return found.slice(0, head).select(["word", "ids"]).combine_chunks()


def _found(words: pa.Array, head: pa.Table) -> np.ndarray:
    """Places of the words in the head (``RARE``: not there)."""
    known = head.column("word").combine_chunks().cast(words.type)
    place = pc.index_in(words, value_set=known).fill_null(RARE)
    return place.to_numpy(zero_copy_only=False)


def _pack(places: np.ndarray, zstd: zstandard.ZstdCompressor) -> bytes:
    """Places below 2**24 by byte planes, compressed."""
    planes = places.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]
    return zstd.compress(np.ascontiguousarray(planes.T).tobytes())


def _unpack(packed: bytes, n: int, zstd: zstandard.ZstdDecompressor) -> np.ndarray:
    raw = zstd.decompress(packed, max_output_size=max(3 * n, 1))
    planes = np.zeros((n, 4), dtype=np.uint8)
    planes[:, :3] = np.frombuffer(raw, dtype=np.uint8).reshape(3, n).T
    return planes.view("<u4").ravel()


def encode(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    head: int = HEAD,
    outputs: Sequence[str] = ("ids", "decoded"),
) -> DataFrame:
    """``key, n_tokens`` and the ``outputs`` for every row: ``ids``, ``decoded`` (the text), and the SHA-256 of the
    decimal ids joined by spaces and of the decoded text (``ids_sha256, decoded_sha256``).

    ``path`` is a vocabulary file that every executor can read at that place.
    """
    context = docs.sparkSession.sparkContext
    table = word_table(docs, path, text)
    frequent = _head(table, head)
    shared, pieces = context.broadcast(frequent), context.broadcast(pa.array(_pieces(path)))
    # A document is known by its key and text; equal rows share one set of rare words.
    marks = {"_a": F.xxhash64(F.col(key), text_of(text)), "_b": F.xxhash64(text_of(text), F.col(key))}
    marks = [c.alias(n) for n, c in marks.items()]
    rows = docs.select(F.col(key).alias("_key"), text_of(text).alias("_text"), *marks)

    def placed(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Words of a batch's texts one after the other, the number of words of each, and their places among the
        frequent words. One look-up serves the batch, as the table's hash is made anew for each."""
        cuts = [cut(part.column("_text")) for part in chunks(batch, "_text", CHUNK)]
        words = pa.concat_arrays([pa.array([], pa.large_string()), *[w.cast(pa.large_string()) for w, _ in cuts]])
        sizes = np.concatenate([np.zeros(0, np.int64), *[s for _, s in cuts]]).astype(np.int64)
        return words, sizes, _found(words, shared.value)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            _, sizes, places = placed(batch)
            parts = np.split(places, np.cumsum(sizes)[:-1]) if len(sizes) else []
            columns = [batch.column("_key"), batch.column("_a"), batch.column("_b")]
            columns += [pa.array(sizes, pa.int32()), pa.array([_pack(p, zstd) for p in parts], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["_key", "_a", "_b", "_n", "_places"])

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, sizes, places = placed(batch)
            at = np.flatnonzero(places == RARE)
            first = np.cumsum(sizes) - sizes
            of = np.searchsorted(first, at, side="right") - 1
            columns = [batch.column(c).take(pa.array(of)) for c in ("_a", "_b")]
            columns += [pa.array((at - first[of]).astype(np.int32)), words.take(pa.array(at)).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["_a", "_b", "_at", "word"])

    key_type = docs.schema[key].dataType.simpleString()
    packed = rows.mapInArrow(lambda b: _lean(pack(b)), f"_key {key_type}, _a long, _b long, _n int, _places binary")
    spread = rows.select("_text", "_a", "_b").mapInArrow(lambda b: _lean(rare(b)), "_a long, _b long, _at int, word string")
    found = spread.join(table.select("word", "ids"), "word")
    gaps = found.groupBy("_a", "_b").agg(
        F.transform(F.array_sort(F.collect_set(F.struct("_at", "ids"))), lambda g: g["ids"]).alias("_gaps")
    )
    joined = packed.join(gaps, ["_a", "_b"], "left").select("_key", "_n", "_places", "_gaps")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.column("ids").combine_chunks()
        zstd = zstandard.ZstdDecompressor()
        for batch in batches:
            ends = np.cumsum(batch.column("_n").to_numpy(zero_copy_only=False))
            part = (ends - 1) // WORDS
            edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows] if batch.num_rows else []
            for low, high in zip(edges, edges[1:]):
                yield spelled(batch.slice(low, high - low), known, pieces.value, zstd)

    def spelled(
        batch: pa.RecordBatch, known: pa.ListArray, pieces: pa.Array, zstd: zstandard.ZstdDecompressor
    ) -> pa.RecordBatch:
        """Some rows spelled out by array operations over all their words."""
        sizes = batch.column("_n").to_numpy(zero_copy_only=False)
        columns = [batch.column("_places"), sizes.tolist()]
        places = [_unpack(p.as_py(), n, zstd) for p, n in zip(*columns)]
        places = np.concatenate([np.zeros(0, np.uint32), *places]).astype(np.int64)
        missing = np.flatnonzero(places == RARE)
        places[missing] = len(known) + np.arange(len(missing))
        own = batch.column("_gaps").flatten().cast(known.type)
        ids = pa.concat_arrays([known, own]).take(pa.array(places))
        # A word without ids (white space that only the library knows) adds nothing.
        lengths = ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(sizes)])]
        flat = ids.flatten()
        offsets = pa.array(ends, pa.int64())
        made = {}
        if "ids" in outputs:
            made["ids"] = pa.LargeListArray.from_arrays(offsets, flat).cast(pa.list_(pa.int32()))
        for name, source in (("ids_sha256", flat), ("decoded", flat), ("decoded_sha256", flat)):
            if name in outputs:
                texts = source.cast(pa.string()) if name.startswith("ids") else pieces.take(source)
                joined = pc.binary_join(pa.LargeListArray.from_arrays(offsets, texts), " ")
                digest = [_sha256(t.as_py()) for t in joined] if name.endswith("sha256") else joined
                made[name] = pa.array(digest, pa.string())
        counts = pa.array(np.diff(ends), pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column("_key"), counts, *[made[c] for c in outputs]], names=[key, "n_tokens", *outputs]
        )

    if set(outputs) - set(SQL):
        raise ValueError(f"outputs are among {', '.join(SQL)}")
    rest = ", ".join(f"{c} {SQL[c]}" for c in outputs)
    return joined.mapInArrow(lambda b: _lean(fill(b)), f"`{key}` {key_type}, n_tokens long, {rest}")


def _pieces(path: str) -> list[str]:
    """The vocabulary's id-to-piece table."""
    tokenizer = _tokenizer(path)
    return [tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size())]


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
