"""Benchmark decontamination: pigeonhole edit matching of test items in whole documents.

Texts become lower-case words of letters and digits; in scripts written without spaces (Han, kana, Thai, Lao, Khmer,
Myanmar) each character, vowel signs included, is a word of its own. An item of ``w`` words may differ by
``k = floor(error_rate * w)`` word edits (insert, delete, replace). Cut into ``k + 1`` pieces, at least one
piece must then occur unchanged, so every exact piece hit (one automaton pass over the whole text) is a
candidate, and no match within the budget is missed. Around each hit Myers' bit-parallel algorithm gives the
edit distance of the item to the best stretch of the document; words are its symbols.

The items are the stated query set. They come to the tasks in blocks of at most ``block_chars`` characters, so neither a
broadcast nor the driver grows with the item table. One block is searched where the documents are read. Several are one
pass over the texts each, so a task builds one automaton; what they find joins the documents by digest of the words.

Defined cases: a NULL text is empty and matches nothing; every item with a word is searched, short ones
without edits as their budget is 0 (a caller that takes short matches for no evidence sets ``min_words``); items with equal words are each
reported; an item found several times in a document is reported once, at its least distance, then
first place; repeated rows are judged alike; empty tables give no match. Other columns are kept as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopmill.llm.common import text_of, unused

ERROR_RATE = 0.15
MIN_WORDS = 1
BLOCK_CHARS = 8_000_000


#: Scripts written without spaces, as members of a character class; those with vowel signs apart.
SIGNED = r"\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
UNSPACED = rf"[\p{{IsHan}}\p{{IsHiragana}}\p{{IsKatakana}}{SIGNED}]"

#: A cheap test that a text can hold a character of these at all.
HIGH = r"[\x{E00}-\x{10FFFF}]"


def normal(text: Column) -> Column:
    """Lower-case runs of letters and digits, single characters in unspaced scripts, one space around each."""
    lower = F.lower(text)
    plain = F.regexp_replace(lower, r"[^\p{L}\p{N}]+", " ")
    kept = F.regexp_replace(lower, r"[^\p{L}\p{N}\p{M}]+", " ")
    kept = F.regexp_replace(kept, rf"[^\p{{L}}\p{{N}}{SIGNED}]+", " ")
    single = F.regexp_replace(F.regexp_replace(kept, UNSPACED, " $0 "), " +", " ")
    may = F.rlike(text, F.lit(HIGH)) & F.rlike(text, F.lit(UNSPACED))
    plain = F.when(may, single).otherwise(plain)
    return F.concat(F.lit(" "), F.btrim(plain), F.lit(" "))


def budget(n_words: int, error_rate: float) -> int:
    return int(n_words * error_rate)


def pieces(words: list[str], k: int) -> list[tuple[int, str]]:
    """``k + 1`` pieces of nearly equal length as (offset, text with a space on both sides)."""
    cuts = [i * len(words) // (k + 1) for i in range(k + 2)]
    return [(a, f" {' '.join(words[a:b])} ") for a, b in zip(cuts, cuts[1:])]


def myers(
    masks: dict[str, int], length: int, window: list[str], anchored: bool = False
) -> tuple[int, int]:
    """Least edits that turn the pattern into some stretch of ``window``, and where that stretch ends.

    ``masks`` has bit i set for the word at place i of the pattern. Ties go to the first end. An
    ``anchored`` stretch begins where the window does.
    """
    full, high = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score = full, 0, length
    best, end = length, 0
    for j, word in enumerate(window, 1):
        eq = masks.get(word, 0)
        x = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | (~(x | plus) & full)
        down = plus & x
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up, down = (up << 1 | anchored) & full, (down << 1) & full
        plus = down | (~((eq | minus) | up) & full)
        minus = up & (eq | minus)
        if score < best:
            best, end = score, j
    return best, end


class Matcher:
    """The automaton and masks of one block of items; built once per Python worker and block."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        self.items, self.automaton = [], ahocorasick.Automaton()
        found: dict[str, list[tuple[int, int]]] = {}
        for number, text in items:
            words = text.split()
            k = budget(len(words), error_rate)
            masks: tuple[dict[str, int], dict[str, int]] = {}, {}  # forwards and backwards
            for i, w in enumerate(words):
                masks[0][w] = masks[0].get(w, 0) | 1 << i
                masks[1][w] = masks[1].get(w, 0) | 1 << len(words) - 1 - i
            self.items.append((number, len(words), k, masks))
            for offset, piece in pieces(words, k):
                found.setdefault(piece, []).append((len(self.items) - 1, offset))
        for piece, uses in found.items():
            self.automaton.add_word(piece, (len(piece), uses))
        if found:
            self.automaton.make_automaton()

    def __call__(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item number, edits, first word, words) of each item found in a normalised text."""
        if not len(self.automaton):
            return []
        hits = list(self.automaton.iter(text))
        if not hits:
            return []
        words, at, before = text.split(), 0, 0
        places: set[tuple[int, int]] = set()
        for end, (length, uses) in hits:
            start = end - length + 1  # the space before the piece; ends rise, starts nearly do
            if start < at:
                before, at = 0, 0
            before += text.count(" ", at, start)
            at = start
            places.update((item, before - offset) for item, offset in uses)
        best: dict[int, tuple[int, int, int]] = {}
        for item, start in sorted(places):
            number, length, k, masks = self.items[item]
            low = max(0, start - k)
            window = words[low : max(start + length + k, 0)]
            edits, end = myers(masks[0], length, window)
            if edits <= k and (number not in best or edits < best[number][0]):
                _, n = myers(masks[1], length, window[:end][::-1], anchored=True)
                best[number] = (edits, low + end - n, n)
        return [(number, *b) for number, b in sorted(best.items())]


_MATCHERS: dict[str, Matcher] = {}


def _matcher(key: str, items: list[tuple[int, str]], error_rate: float) -> Matcher:
    if key not in _MATCHERS:
        _MATCHERS.clear()  # one block at a time
        _MATCHERS[key] = Matcher(items, error_rate)
    return _MATCHERS[key]


def _blocks(items: DataFrame, block_chars: int) -> Iterator[list]:
    block, size = [], 0
    for row in items.toLocalIterator():  # the driver holds one block at a time
        if block and size + len(row["words"]) > block_chars:
            yield block
            block, size = [], 0
        block.append(row)
        size += len(row["words"])
    if block:
        yield block


def contamination(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    error_rate: float = ERROR_RATE,
    min_words: int = MIN_WORDS,
    block_chars: int = BLOCK_CHARS,
    out: str = "matches",
) -> DataFrame:
    """``docs`` with an array column ``out`` of (item, edits, first_word, words), empty where a text is clean.

    ``item`` has the type of ``item_key``. A column already named ``out`` is replaced.
    """
    kind = items.schema[item_key].dataType
    plain = F.btrim(normal(text_of(item_text)))
    queries = items.select(F.col(item_key).alias("item"), plain.alias("words")).filter(
        (F.col("words") != "") & (F.size(F.split("words", " ")) >= min_words)
    )
    row = T.StructType(
        [T.StructField("item", kind)]
        + [T.StructField(n, T.IntegerType()) for n in ("edits", "first_word", "words")]
    )
    context = docs.sparkSession.sparkContext

    def searcher(block: list) -> Callable[[str], Column]:
        ids = [r["item"] for r in block]
        name = uuid.uuid4().hex
        shared = context.broadcast(([(i, r["words"]) for i, r in enumerate(block)], ids))

        @F.pandas_udf(T.ArrayType(row))
        def search(texts: pd.Series) -> pd.Series:
            numbered, ids = shared.value
            match = _matcher(name, numbered, error_rate)
            return pd.Series([[(ids[n], *rest) for n, *rest in match(t)] for t in texts])

        return search.asNondeterministic()  # or filters on the result would search once more

    searches = [searcher(block) for block in _blocks(queries, block_chars)]
    none = F.array().cast(T.ArrayType(row))
    if not searches:
        return docs.withColumn(out, none)
    plain = unused(docs, "_plain")
    if len(searches) == 1:
        return docs.withColumn(plain, normal(text_of(text))).withColumn(out, searches[0](plain)).drop(plain)
    mark, found = unused(docs, "_mark"), unused(docs, "_found")
    digest = lambda words: F.sha2(words, 256)
    texts = docs.select(normal(text_of(text)).alias("words"))
    parts = [
        texts.select(digest("words").alias(mark), F.lit(number).alias("block"), search("words").alias("found"))
        for number, search in enumerate(searches)
    ]
    hits = reduce(DataFrame.unionAll, parts).filter(F.size("found") > 0)
    # Equal texts have equal finds; a text has at most one row a block then.
    hits = hits.groupBy(mark, "block").agg(F.first("found").alias("found"))
    hits = hits.groupBy(mark).agg(F.array_sort(F.collect_list(F.struct("block", "found"))).alias(found))
    hits = hits.select(mark, F.flatten(F.transform(found, lambda b: b["found"])).alias(found))
    marked = docs.withColumn(mark, digest(normal(text_of(text)))).join(hits, mark, "left")
    return marked.withColumn(out, F.coalesce(found, none)).drop(mark, found)
