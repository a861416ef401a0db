"""MinHash near-dedup: circulant signatures, banding, exact Jaccard verification, components.

A text is the set of its distinct word shingles. Texts with equal sets are one node. Signatures use two
permutations of the 32-bit ring: one places a shingle, the second, shifted on by one step for each
coordinate, ranks it; the least rank is the coordinate. Bands of coordinates put nodes into buckets. Whether two
nodes of a bucket are linked is always decided on their full sets.

What is wanted are the components of the links, so a pair need not be tested once its ends are known to be
connected. For ``rounds`` rounds every node of a bucket that is not yet of one component is tested against one
random member (its hub) and components are joined. Then all remaining pairs of a bucket that still lie in
different components are tested, in blocks of bounded size, so no link that matters is lost and no group is
expanded into rows of pairs.

With 32 bands of 5, a pair at similarity 0.8 shares no bucket with probability 3e-6, one at 0.9 with 1e-12.

Defined cases: a NULL or blank text has no shingle and is linked with nothing; a text of fewer words than
a shingle is one shingle; rows with equal sets (copies, repeated rows) are linked without signatures; a
component without any non-NULL id has component NULL; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmill.llm.common import let, text_of, words_of
from shopmill.operators.scale import durable

PERCENT = 80
WIDTH = 5
BANDS, ROWS = 32, 5
ROUNDS = 2
SEED = 77
BLOCK = 512  # sets of either side that one task compares with each other
FILE_ROWS = 200_000
CHUNK = 1 << 17  # shingles whose signatures are computed at once

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case, nothing else changed."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def shingles(text: Column, width: int) -> Column:
    """Distinct 64-bit hashes of the runs of ``width`` words; of all words if there are fewer."""

    def of(hashes: Column) -> Column:
        run = lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(width)])
        starts = F.sequence(F.lit(0), F.size(hashes) - width)
        return (
            F.when(F.size(hashes) == 0, F.array().cast("array<bigint>"))
            .when(F.size(hashes) < width, F.array(F.xxhash64(F.lit("short"), hashes)))
            .otherwise(F.array_distinct(F.transform(starts, run)))
        )

    return let(F.transform(words_of(lower_ascii(text)), lambda w: F.xxhash64(w)), of)


def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 32-bit ring, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def _mix64(x: np.ndarray, seed: int) -> np.ndarray:
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signatures(values: np.ndarray, starts: np.ndarray, n: int, seed: int = SEED) -> np.ndarray:
    """Circulant MinHash: ``n`` coordinates (columns) of the sets that begin at ``starts`` (none empty)."""
    ring = (_mix64(values, seed) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    first = _mix(ring)  # where the first permutation puts each shingle
    out = np.empty((len(starts), n), dtype=np.uint32)
    for k in range(n):  # the second permutation, shifted on by k
        out[:, k] = np.minimum.reduceat(_mix(first + np.uint32(k)), starts)
    return out


def _bands(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    wide = signature.astype(np.uint64).reshape(len(signature), bands, rows)
    out = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[None, :], len(signature), axis=0)
    for r in range(rows):
        out = _mix64(out ^ (wide[:, :, r] * np.uint64(0x9E3779B97F4A7C15)), r + 1)
    return out.view(np.int64)


def nodes_of(docs: DataFrame, key: str, text: str, width: int, bands: int, rows: int) -> DataFrame:
    """``key, _t`` (hash of the text), ``_n`` (set size), ``_node`` (the set's 128-bit name) and ``_bands`` per row."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = batch.column("_set")
            sizes = np.diff(sets.offsets.to_numpy())
            values = sets.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            full = sizes > 0
            names = np.zeros((len(sizes), 2), dtype=np.uint64)
            signed = np.zeros((len(sizes), bands), dtype=np.int64)
            ends = np.cumsum(sizes)
            rows_left = np.flatnonzero(full)
            while len(rows_left):  # whole sets, about CHUNK shingles at a time
                begin = ends[rows_left[0]] - sizes[rows_left[0]]
                take = rows_left[: max(1, np.searchsorted(ends[rows_left], begin + CHUNK, "right"))]
                part = values[begin : ends[take[-1]]]
                starts = ends[take] - sizes[take] - begin
                for c in (0, 1):
                    names[take, c] = np.add.reduceat(_mix64(part, 101 + c), starts)
                signed[take] = _bands(signatures(part, starts, bands * rows), bands, rows)
                rows_left = rows_left[len(take) :]
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(full * bands)]), pa.int32()), pa.array(signed[full].ravel())
            )
            node = pa.array([n.tobytes() if f else None for n, f in zip(names, full)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), batch.column("_t"), pa.array(sizes, pa.int64()), node, lists],
                names=["_key", "_t", "_n", "_node", "_bands"],
            )

    kind = docs.schema[key].dataType.simpleString()
    whole = text_of(text)
    sets = docs.select(F.col(key).alias("_key"), F.xxhash64(whole).alias("_t"), shingles(whole, width).alias("_set"))
    return sets.mapInArrow(sign, f"_key {kind}, _t long, _n long, _node binary, _bands array<long>")


def similar(a: Column, b: Column, percent: int) -> Column:
    """Exact: 100 * intersection >= percent * union."""
    return let(
        F.size(F.array_intersect(a, b)), lambda i: 100 * i >= percent * (F.size(a) + F.size(b) - i)
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``x, y`` (with sizes ``nx, ny``) whose full sets are similar enough."""
    possible = pairs.filter(100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny"))
    joined = possible.select("x", "y").join(sets.toDF("x", "sx"), "x").join(sets.toDF("y", "sy"), "y")
    return joined.filter(similar(F.col("sx"), F.col("sy"), percent)).select("x", "y")


def _compact(df: DataFrame, rows: int) -> DataFrame:
    """``durable`` in as few files as ``rows`` rows of a few numbers need."""
    return durable(df.coalesce(rows // FILE_ROWS + 1))


def connect(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (node, comp) after joining the components at the ends of ``edges`` (x, y).

    Least label wins. Each step takes the least label among a component's own, its neighbours' and its
    label's (pointer jumping), so the number of steps grows with the logarithm of a chain's length.
    """
    ends = edges.join(labels.toDF("x", "a"), "x").join(labels.toDF("y", "b"), "y")
    ends = ends.select("a", "b").filter("a <> b")
    both = durable(ends.union(ends.select("b", "a")).distinct())
    n = both.count()
    if not n:
        return labels
    both = _compact(both, n)
    roots = _compact(both.groupBy("a").agg(F.least("a", F.min("b")).alias("low")), n)
    while True:
        near = both.join(roots.toDF("b", "l"), "b").select("a", "l")
        jump = roots.join(roots.toDF("low", "l"), "low").select("a", "l")
        own = roots.select("a", F.col("low").alias("l"), F.col("low").alias("was"))
        every = own.unionByName(near.union(jump), allowMissingColumns=True)
        step = _compact(every.groupBy("a").agg(F.min("l").alias("low"), F.max("was").alias("was")), n)
        roots = step.select("a", "low")
        if step.filter("low < was").isEmpty():
            break
    return durable(
        labels.join(roots.toDF("comp", "low"), "comp", "left").select(
            "node", F.coalesce("low", "comp").alias("comp")
        )
    )


def _rest(still: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Links ``x, y`` among all pairs of a bucket that lie in different components, tested in blocks.

    ``x`` runs over the members outside the bucket's largest component, ``y`` over all members. Both
    are dealt into blocks; a task gets one block of each with their sets, tests every pair there
    and returns one link for each ``x`` and component. A pair is tested in the first band it shares.
    """
    place = ["band", "bucket"]
    by_comp = still.groupBy(*place, "comp").agg(F.count("*").alias("m"))
    sizes = by_comp.groupBy(*place).agg(F.sum("m").alias("all"), F.max(F.struct("m", "comp")).alias("most"))
    # A bucket's blocks: counts of a few per bucket, not rows of pairs.
    blocks = sizes.select(
        *place,
        F.col("most.comp").alias("largest"),
        F.ceil((F.col("all") - F.col("most.m")) / block).cast("int").alias("bx"),
        F.ceil(F.col("all") / block).cast("int").alias("by"),
    )
    full = nodes.select("node", "bands").join(sets, "node")
    rows = still.select(*place, "node", "comp").join(blocks, place).join(full, "node")
    slot = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    key = [*place, "i", "j"]
    columns = [*key, "node", "comp", "bands", "set"]
    outside = rows.filter("comp <> largest").withColumn("i", slot("bx")).withColumn("j", every("by"))
    inside = rows.withColumn("j", slot("by")).withColumn("i", every("bx")).select(*columns)
    outside = outside.select(*columns)

    def test(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        links = []
        x = x.set_axis(y.columns, axis=1)
        if len(x) and len(y):
            band = int(x["band"].iloc[0])
            bands = np.array(y["bands"].tolist())
            sizes = np.array([len(v) for v in y["set"]])
            values = np.concatenate(y["set"].tolist())
            order = np.argsort(values, kind="stable")
            values, owner = values[order], np.repeat(np.arange(len(y)), sizes)[order]
            comps, names = y["comp"].to_numpy(), y["node"].to_numpy()
            for node, comp, own, mine in zip(x["node"], x["comp"], x["bands"], x["set"]):
                first = (bands == np.asarray(own)).argmax(axis=1) == band
                small, large = np.minimum(sizes, len(mine)), np.maximum(sizes, len(mine))
                wanted = first & (comps != comp) & (100 * small >= percent * large)
                if wanted.any():
                    low, high = (np.searchsorted(values, mine, side) for side in ("left", "right"))
                    n = high - low  # holders of each shingle
                    holders = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    common = np.bincount(owner[holders], minlength=len(y))
                    hit = wanted & (100 * common >= percent * (sizes + len(mine) - common))
                    for k in np.unique(comps[hit], return_index=True)[1]:
                        links.append((node, names[hit][k]))
        return pd.DataFrame(links, columns=["x", "y"])

    return (
        outside.toDF(*[f"x_{c}" for c in columns])
        .groupBy(*[f"x_{c}" for c in key])
        .cogroup(inside.groupBy(*key))
        .applyInPandas(test, "x long, y long")
        .distinct()
    )


def components(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    rounds: int = ROUNDS,
    block: int = BLOCK,
    label: str | None = None,
) -> DataFrame:
    """``key, n_shingles, component_id`` (least key of the component) and ``text_hash`` for every row.

    ``label`` names a further column, the component's internal number: NULL keys have one as well, blank texts none.
    """
    marked = durable(nodes_of(docs, key, text, width, bands, rows))
    nodes = marked.filter("_node is not null").groupBy("_node")
    nodes = nodes.agg(
        F.first("_bands").alias("bands"),
        F.first("_n").alias("n"),
        F.min(F.struct("_key", "_t")).alias("rep"),
        F.min("_key").alias("least"),
    )
    nodes = durable(nodes.withColumn("node", F.monotonically_increasing_id()))  # short names, written down
    entries = nodes.select("node", "n", F.posexplode("bands").alias("band", "bucket"))
    shared = entries.groupBy("band", "bucket").agg(F.count("*").alias("m")).filter("m > 1").drop("m")
    open_entries = durable(entries.join(shared, ["band", "bucket"]).select("band", "bucket", "node", "n"))
    members = open_entries.select("node").distinct()
    labels = durable(members.select("node", F.col("node").alias("comp")))

    # Full sets of the nodes in shared buckets, from one document of each.
    reps = labels.select("node").join(nodes, "node")
    reps = reps.select("node", F.col("rep._key").alias("_k"), F.col("rep._t").alias("_h"))
    whole = text_of(text)
    source = docs.select(F.col(key).alias("_key"), whole.alias("_text"), F.xxhash64(whole).alias("_t"))
    found = source.join(reps, F.expr("_t = _h and _key <=> _k"))
    sets = durable(
        found.select("node", shingles(F.col("_text"), width).alias("set")).dropDuplicates(["node"])
    )

    for number in range(rounds + 1):
        state = open_entries.join(labels, "node")
        split = state.groupBy("band", "bucket").agg(
            F.min_by(F.struct("node", "n", "comp"), F.xxhash64("node", F.lit(number))).alias("hub"),
            F.min("comp").alias("low"),
            F.max("comp").alias("high"),
        )
        split = split.filter("low <> high").select("band", "bucket", "hub")
        still = durable(state.join(split, ["band", "bucket"]))
        if still.isEmpty():
            break
        if number < rounds:
            pairs = still.filter(F.col("comp") != F.col("hub.comp")).select(
                F.col("node").alias("x"), F.col("n").alias("nx"), F.col("hub.node").alias("y"), F.col("hub.n").alias("ny")
            )
            edges = _verified(pairs.distinct(), sets, percent)
        else:
            edges = _rest(still, nodes, sets, percent, block)
        labels = connect(labels, durable(edges))
        open_entries = still.select("band", "bucket", "node", "n")

    comps = nodes.select("_node", "node", "least").join(labels, "node", "left")
    comps = comps.select("_node", "least", F.coalesce("comp", "node").alias("comp"))
    least = comps.groupBy("comp").agg(F.min("least").alias("component_id"))
    number = [F.col("comp").alias(label)] if label else []
    known = durable(comps.join(least, "comp").select("_node", "component_id", *number))
    return marked.join(known, "_node", "left").select(
        F.col("_key").alias(key),
        F.col("_n").alias("n_shingles"),
        F.when(F.col("_node").isNull(), F.col("_key")).otherwise(F.col("component_id")).alias("component_id"),
        F.col("_t").alias("text_hash"),
        *([label] if label else []),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of near copies: that of the least key, NULL last, then of the
    least text hash. Blank texts all stay."""
    found = components(docs, key, text, label="_comp", **options)
    blank = F.col("_comp").isNull()
    place = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("_k"), F.col("text_hash").alias("_h"))
    first = found.groupBy("_comp", F.when(blank, place).alias("_own")).agg(F.min(place).alias("_first"))
    own = F.struct(F.col("_first._k").alias("k"), F.col("_first._h").alias("h"))
    first = first.select(own.alias("_id"), blank.alias("_blank"))
    # The whole row in one column, so that no name of the caller's meets one of these; one join key, so that copies of a
    # row that stays are folded where the join has brought them.
    mark = F.struct(F.col(key).alias("k"), F.xxhash64(text_of(text)).alias("h"))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"), mark.alias("_id"))
    kept = rows.join(first, "_id")
    blank = kept.filter("_blank").select("_row.*")
    return kept.filter("not _blank").dropDuplicates(["_id"]).select("_row.*").unionAll(blank)
