"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

A transcript is a sequence of lines without reliable roles. Hidden states are a role and whether the line begins a
turn of that role or continues it. A line is observed through independent features: the speaker marker it
starts with, its length, how it ends, whether it opens the transcript. Counts over labelled lines give the
probabilities; Viterbi's algorithm finds the most likely states.

The path is found in blocks of ``BLOCK`` turns: each block is first reduced to a table of best scores from any state
before it to any state at its end, these tables are chained for each conversation, and then every block is decoded between
its known ends. So one conversation of any length is spread over many tasks.

Input lines are rows (conversation, ``turn``, ``line``, text) in the order of (turn, line, text). Defined cases: a NULL text is an empty line;
a NULL turn comes first; lines without a conversation id are a transcript each; repeated rows count once; lines that tie go by their text; an
empty table gives no turn; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopmill.llm.common import text_of

ROLES = ("system", "user", "assistant")
STATES = tuple((role, begins) for role in ROLES for begins in (True, False))
BLOCK = 64  # turns of the input in a block

#: Speaker markers by role; a line may start with one, then a colon or the closing sign.
MARKERS = {
    "system": ("system", "context", "instructions"),
    "user": ("user", "human", "question", "customer", "q", "me"),
    "assistant": ("assistant", "ai", "bot", "answer", "agent", "model", "a"),
}
SPEAKER = r"(?i)^\s{{0,8}}(?:[<\[(*#]{{1,3}}\s?)?(?:{names})\s?(?:[>\])*]{{1,3}}:?|:)[*]{{0,2}}\s{{0,8}}"
ANY_SPEAKER = SPEAKER.format(names="|".join(n for names in MARKERS.values() for n in names))

FEATURES = (("marker", 4), ("length", 6), ("ending", 4), ("first", 2))
SMOOTHING = 0.5


def observed(text: Column, first: Column) -> list[Column]:
    """The categories of a line's features, in the order of ``FEATURES``."""
    marker = F.lit(0)
    for number, role in enumerate(ROLES, 1):
        marker = F.when(F.rlike(text, F.lit(SPEAKER.format(names="|".join(MARKERS[role])))), number).otherwise(marker)
    n = F.char_length(text)
    length = F.when(n == 0, 0)
    for bucket, most in enumerate((40, 120, 300, 900), 1):
        length = length.when(n <= most, bucket)
    ending = F.when(F.endswith(text, F.lit("?")), 1).when(F.endswith(text, F.lit(":")), 2)
    ending = ending.when(F.rlike(text, F.lit(r"[.!]$")), 0).otherwise(3)
    return [marker, length.otherwise(5), ending, F.when(first, 1).otherwise(0)]


class Model(NamedTuple):
    start: np.ndarray  # log probability of the first state
    move: np.ndarray  # of the next state, by state
    emit: list[np.ndarray]  # of each feature's categories, by state

    def scores(self, seen: np.ndarray) -> np.ndarray:
        """Log probability of each line (row) in each state."""
        return sum(e[:, seen[:, i]].T for i, e in enumerate(self.emit))


def _log_shares(counts: np.ndarray) -> np.ndarray:
    counts = counts + SMOOTHING
    return np.log(counts / counts.sum(axis=-1, keepdims=True))


def block_table(model: Model, scores: np.ndarray, opening: bool) -> np.ndarray:
    """Best scores from each state before the block (all rows alike if it opens a transcript) to each at its end."""
    table = np.tile(model.start, (len(STATES), 1)) if opening else model.move.copy()
    table = table + scores[0]
    for s in scores[1:]:
        table = (table[:, :, None] + model.move[None]).max(axis=1) + s
    return table


def viterbi(model: Model, scores: np.ndarray, before: int = -1, last: int = -1) -> np.ndarray:
    """Best states of a block's lines given the state before it (-1: the block opens) and at its end (-1: free)."""
    best = (model.start if before < 0 else model.move[before]) + scores[0]
    back = np.zeros((len(scores), len(STATES)), dtype=np.int64)
    for t in range(1, len(scores)):
        ways = best[:, None] + model.move
        back[t] = ways.argmax(axis=0)
        best = ways.max(axis=0) + scores[t]
    path = np.empty(len(scores), dtype=np.int64)
    path[-1] = best.argmax() if last < 0 else last
    for t in range(len(scores) - 1, 0, -1):
        path[t - 1] = back[t, path[t]]
    return path


#: Every combination of features; a line's is a number, its place here.
SEEN = np.stack(np.unravel_index(np.arange(np.prod([n for _, n in FEATURES])), [n for _, n in FEATURES]), axis=1)
CELLS = 1 << 18  # lines, padding included, that are decoded at once


def numbered(seen: Column) -> Column:
    """The place in ``SEEN`` of an array of categories."""
    place = F.lit(0)
    for i, (_, size) in enumerate(FEATURES):
        place = place * size + F.get(seen, F.lit(i))
    return place.cast("int")


def paths(model: Model, blocks: list[np.ndarray], before: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
    """``viterbi`` of many blocks, each an array of places in ``SEEN``, line by line over all of them at once.

    Blocks of like length go together, so little is padded; a block beyond ``CELLS`` lines goes alone.
    """
    known = model.scores(SEEN)
    lengths = np.array([len(b) for b in blocks], dtype=np.int64)
    order, found, at = np.argsort(-lengths, kind="stable"), [None] * len(blocks), 0
    while at < len(order):
        longest = lengths[order[at]]
        these = order[at : at + max(1, CELLS // longest)]
        at += len(these)
        # Blocks are sorted: those with a line ``t`` are the first ``left[t]``.
        left = (lengths[these][:, None] > np.arange(longest)).sum(axis=0)
        places = np.zeros((len(these), longest), dtype=np.int64)
        for row, b in zip(places, these):
            row[: lengths[b]] = blocks[b]
        entered, ends = before[these], last[these]
        best = np.where(entered[:, None] < 0, model.start, model.move[entered]) + known[places[:, 0]]
        back = np.zeros((longest, len(these), len(STATES)), dtype=np.int8)
        for t in range(1, longest):
            n = left[t]
            ways = best[:n, :, None] + model.move
            back[t, :n] = ways.argmax(axis=1)
            best[:n] = ways.max(axis=1) + known[places[:n, t]]
        state = np.where(ends < 0, best.argmax(axis=1), ends)
        path = np.zeros((len(these), longest), dtype=np.int32)
        for t in range(longest - 1, -1, -1):
            n = left[t]
            path[:n, t] = state[:n]
            state[:n] = back[t, np.arange(n), state[:n]]
        for row, b in zip(path, these):
            found[b] = row[: lengths[b]]
    return found


def chain(tables: list[np.ndarray]) -> list[tuple[int, int]]:
    """(state before, state at the end) of each block of a conversation, along the best path; -1 before the first."""
    best, back = tables[0][0], []
    for table in tables[1:]:
        ways = best[:, None] + table
        back.append(ways.argmax(axis=0))
        best = ways.max(axis=0)
    ends = [int(best.argmax())]
    for b in reversed(back):
        ends.append(int(b[ends[-1]]))
    ends.reverse()
    return list(zip([-1, *ends], ends))


ORDER = ("turn", "line", "text")
_PLACE = ("_conv", "_solo", "_block")


def _placed(lines: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``lines`` with ``_conv, _solo, _block``, typed ``turn, line, text``, each row once."""
    whole = text_of(text)
    solo = F.when(F.col(key).isNull(), F.xxhash64("turn", "line", whole))
    rows = lines.withColumns(
        {
            "_conv": F.col(key),
            "_solo": F.coalesce(solo, F.lit(0)),
            "_block": F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(2**40))).cast("long"),
            "turn": F.col("turn").cast("long"),
            "line": F.col("line").cast("long"),
            "text": whole,
        }
    )
    return rows.distinct()


def _join_blocks(rows: DataFrame, blocks: DataFrame, *columns: str) -> DataFrame:
    """``rows`` with ``columns`` of ``blocks``, one row a block at most."""
    names = {p: f"_b{p}" for p in _PLACE}
    other = blocks.select(*[F.col(p).alias(n) for p, n in names.items()], *columns)
    on = F.lit(True)
    for p, n in names.items():
        on = on & (F.col(p).eqNullSafe(F.col(n)) if p == "_conv" else F.col(p) == F.col(n))
    return rows.join(other, on, "left").drop(*names.values())


def _with_before(rows: DataFrame, value: Column) -> DataFrame:
    """``rows`` with ``_before``, the value of the line before in the conversation (NULL for the first).

    Lines are sorted within blocks only; one row a block carries the last value over.
    """
    inner = Window.partitionBy(*_PLACE).orderBy(*ORDER)
    rows = rows.withColumn("_value", value)
    ends = rows.groupBy(*_PLACE).agg(F.max_by("_value", F.struct(*ORDER)).alias("_end"))
    over = Window.partitionBy("_conv", "_solo").orderBy("_block")
    ends = ends.withColumn("_carried", F.lag("_end").over(over))
    joined = _join_blocks(rows, ends, "_carried")
    before = F.coalesce(F.lag("_value").over(inner), F.col("_carried"))
    return joined.withColumn("_before", before).drop("_value", "_carried")


def prepared(lines: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``_conv, _solo, _block, turn, line, text, opens, seen``: lines with features, ready for decoding.

    ``opens`` marks the lines of a conversation's first block; ``alone`` those of one that has no other.
    """
    rows = _placed(lines.select(key, "turn", "line", text), key, text)
    over = Window.partitionBy("_conv", "_solo")
    blocks = rows.groupBy(*_PLACE).agg(F.min(F.struct(*ORDER)).alias("_least"))
    blocks = blocks.select(
        *_PLACE,
        F.col("_least"),
        (F.min("_block").over(over) == F.col("_block")).alias("opens"),
        (F.min("_block").over(over) == F.max("_block").over(over)).alias("alone"),
    )
    rows = _join_blocks(rows, blocks, "_least", "opens", "alone")
    first = F.col("opens") & F.struct(*ORDER).eqNullSafe(F.col("_least"))
    seen = F.array(*[c.cast("int") for c in observed(F.col("text"), first)])
    return rows.select(*_PLACE, *ORDER, "opens", "alone", seen.alias("seen"))


def fit(lines: DataFrame, key: str, role: str = "role", begins: str = "begins", text: str = "text") -> Model:
    """Count over labelled lines (``role`` one of ROLES, ``begins`` whether the line starts a turn); others are left out.

    Every count is an aggregate; a few hundred numbers reach the driver.
    """
    state = F.lit(-1)
    for number, (r, b) in enumerate(STATES):
        state = F.when((F.lower(role) == r) & (F.col(begins) == F.lit(b)), number).otherwise(state)
    known = lines.filter(F.col(key).isNotNull()).withColumn("_state", state).filter("_state >= 0")
    known = _with_before(_placed(known.select(key, "turn", "line", text, "_state"), key, text), F.col("_state"))
    seen = observed(text_of(text), F.col("_before").isNull())
    starts, moves = np.zeros(len(STATES)), np.zeros((len(STATES), len(STATES)))
    emits = [np.zeros((len(STATES), size)) for _, size in FEATURES]
    names = [f"f{i}" for i in range(len(FEATURES))]
    known = known.select("_state", "_before", *[c.alias(n) for c, n in zip(seen, names)])
    for r in known.groupBy("_state", "_before", *names).agg(F.count("*").alias("n")).collect():
        if r["_before"] is None:
            starts[r["_state"]] += r["n"]
        else:
            moves[r["_before"], r["_state"]] += r["n"]
        for i, n in enumerate(names):
            emits[i][r["_state"], r[n]] += r["n"]
    return Model(_log_shares(starts), _log_shares(moves), [_log_shares(e) for e in emits])


def decode(lines: DataFrame, model: Model, key: str, text: str = "text") -> DataFrame:
    """``key, turn, line, text, role, begins`` for every line, ``role`` and ``begins`` recovered."""
    rows = prepared(lines, key, text)
    conv_type = lines.schema[key].dataType.simpleString()
    shared = lines.sparkSession.sparkContext.broadcast(model)  # a few hundred numbers

    @F.pandas_udf("array<double>")
    def table(places: pd.Series, opens: pd.Series) -> pd.Series:
        known = shared.value.scores(SEEN)
        return pd.Series([block_table(shared.value, known[p], o).ravel() for p, o in zip(places, opens)])

    @F.pandas_udf("array<int>")
    def path(places: pd.Series, before: pd.Series, last: pd.Series) -> pd.Series:
        return pd.Series(paths(shared.value, list(places), before.to_numpy(), last.to_numpy()))

    def chained(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_block")
        size = len(STATES)
        ends = chain([np.array(t).reshape(size, size) for t in pdf["table"]])
        return pdf[["_conv", "_solo", "_block"]].assign(before=[a for a, _ in ends], last=[b for _, b in ends])

    # One row a block; only the places of its lines go to Python, its texts stay where they are.
    line = F.struct(*ORDER, numbered(F.col("seen")).alias("place"))
    blocks = rows.groupBy(*_PLACE, "opens", "alone").agg(F.array_sort(F.collect_list(line)).alias("_lines"))
    blocks = blocks.withColumn("_places", F.col("_lines.place"))
    reduced = blocks.filter("not alone").select(*_PLACE, table("_places", "opens").alias("table"))
    # One row a block of a conversation, 36 numbers each.
    ends = reduced.groupBy("_conv", "_solo").applyInPandas(
        chained, f"_conv {conv_type}, _solo long, _block long, before int, last int"
    )
    bounded = _join_blocks(blocks, ends, "before", "last").na.fill(-1, ["before", "last"])
    found = path.asNondeterministic()("_places", "before", "last")  # or a filter would decode once more
    each = F.explode(F.arrays_zip("_lines", "_path")).alias("_each")
    states = bounded.select("_conv", "_lines", found.alias("_path")).select("_conv", each)
    role, begins = (F.get(F.lit(list(of)), F.col("_each._path")) for of in zip(*STATES))
    return states.select(
        F.col("_conv").alias(key), *[F.col(f"_each._lines.{c}") for c in ORDER], role.alias("role"), begins.alias("begins")
    )


def turns(decoded: DataFrame, key: str) -> DataFrame:
    """``key, turn, role, text, chat``: canonical turns numbered from 0, speaker markers removed.

    ``text`` joins a turn's lines; ``chat`` is its rendering between role and end signs.
    """
    rows = _with_before(_placed(decoded, key), F.col("role"))
    new = F.col("begins") | ~F.col("role").eqNullSafe(F.col("_before"))
    rows = rows.withColumn("_new", new.cast("long"))
    over = Window.partitionBy("_conv", "_solo").orderBy("_block")
    counts = rows.groupBy(*_PLACE).agg(F.sum("_new").alias("_n"))
    counts = counts.withColumn("_past", F.sum("_n").over(over) - F.col("_n"))
    line = Window.partitionBy(*_PLACE).orderBy(*ORDER)
    rows = _join_blocks(rows, counts, "_past")
    rows = rows.withColumn("_turn", F.col("_past") + F.sum("_new").over(line) - 1)
    plain = F.when(F.col("_new") == 1, F.regexp_replace("text", ANY_SPEAKER, "")).otherwise(F.col("text"))
    gathered = (
        rows.withColumn("_plain", plain)
        .groupBy(F.col("_conv").alias(key), "_solo", "_turn")
        .agg(
            F.min_by("role", F.struct(*ORDER)).alias("role"),
            F.array_sort(F.collect_list(F.struct(*ORDER, "_plain"))).alias("_lines"),
        )
    )
    joined = F.array_join(F.transform("_lines", lambda s: s["_plain"]), "\n")
    return gathered.select(
        key, F.col("_turn").cast("long").alias("turn"), "role", joined.alias("text"),
        F.concat(F.lit("<|"), "role", F.lit("|>\n"), joined, F.lit("\n<|end|>")).alias("chat"),
    )
