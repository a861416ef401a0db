"""The text operators as queries over a data folder, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopmill.llm import (
    bpe,
    chat,
    decontamination,
    filter_audit,
    near_dedup,
    periodic_runs,
    pii,
    pu_quality,
    quality_rules,
    secret_scan,
    sharding,
    substring_dedup,
    toxicity,
)
from shopmill.llm.common import let, show_package, table, words_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        show_package(spark)
        return build(spark, folder)

    QUERIES[build.__name__] = run
    return build


@query
def op1_quality_rules(spark, folder):
    """Base counts of each document and whether rules and log-likelihood ratio keep it."""
    docs = table(spark, folder, "documents")
    trusted = table(spark, folder, "labels").filter("quality = 1")
    model = quality_rules.fit(docs, trusted)
    return quality_rules.judge(docs.select("doc_id", "text"), model).select("doc_id", "quality.*")


@query
def op2_near_dedup(spark, folder):
    """Component of near copies of each document, on two-word shingles."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = near_dedup.components(docs, width=2)
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


@query
def op3_pii(spark, folder):
    """Personal-data spans of each document: how many of each kind, a digest of the plain ones, and all spans."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    marked = pii.mark(docs, pii.fit(docs)).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return marked.select(
        "doc_id",
        *[count(k) for k in pii.KINDS],
        F.sha2(pii.span_list(base), 256).alias("base_sha256"),
        pii.span_list(F.col("spans")).alias("spans"),
    )


def _remainder(n: int):
    """crc32 of the id as text, modulo ``n``; -1 without an id."""
    crc = F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8"))
    return F.coalesce(F.pmod(crc, F.lit(n)).cast("int"), F.lit(-1))


@query
def op6_pu_quality(spark, folder):
    """Probability of good quality of each document, learnt from trusted positives and unlabelled text."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    good = table(spark, folder, "labels").filter("quality = 1")
    model = pu_quality.fit(docs, good, allowed=_remainder(3) != 1)
    return pu_quality.score(docs, model).select(
        "doc_id",
        (_remainder(3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op8_toxicity(spark, folder):
    """Toxicity of each document by its most toxic string."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").filter(_remainder(5) != 0)
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs, model).select(
        "doc_id",
        (_remainder(5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


#: Speaker names of the transcripts made from ``conversations``, by style: system, user, assistant.
STYLES = (
    ("System: ", "User: ", "Assistant: "),
    ("context: ", "Human: ", "AI: "),
    ("[system] ", "Q: ", "A: "),
    ("<system> ", "<user> ", "<bot> "),
)


def transcripts(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, line, text, role, begins``: lines of raw transcripts.

    A conversation has one style of speaker names; every fifth turn lost its name.
    """
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    name = F.lit("")
    for s, names in enumerate(STYLES):
        for role, n in zip(chat.ROLES, names):
            name = F.when((style == s) & (F.col("role") == role), n).otherwise(name)
    lost = F.pmod(F.xxhash64(F.lit("lost"), "conv_id", "turn"), F.lit(5)) == 0
    lines = F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line", "text")
    rows = conversations.select(
        "conv_id", "turn", "role", F.when(lost, "").otherwise(name).alias("_name"), lines
    )
    begins = F.col("line") == 0
    text = F.when(begins, F.concat("_name", "text")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", "line", text.alias("text"), "role", begins.alias("begins"))


@query
def op4_chat(spark, folder):
    """Canonical turns of every conversation, roles recovered from raw transcripts.

    The model is counted on conversations with an even checksum and applied to all.
    """
    lines = transcripts(table(spark, folder, "conversations"))
    even = F.pmod(F.crc32(F.encode(F.col("conv_id").cast("string"), "utf-8")), F.lit(2)) == 0
    model = chat.fit(lines.filter(even), "conv_id")
    return chat.turns(chat.decode(lines, model, "conv_id"), "conv_id")


@query
def op5_secret_scan(spark, folder):
    """Secret spans of each document: how many of each fixed kind, a digest of those, and all spans."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scanned = secret_scan.scan(docs).select("doc_id", "secrets")

    def count(kind: str):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = secret_scan.span_list(F.filter("secrets", lambda s: s["base"]))
    return scanned.select(
        "doc_id",
        *[count(k) for k in ("assign", "access", "hex")],
        F.sha2(base, 256).alias("base_sha256"),
        secret_scan.span_list(F.col("secrets")).alias("spans"),
    )


@query
def op7_bpe(spark, folder):
    """Token counts and digests of the ids and of the decoded text of each document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.encode(docs, bpe.vocabulary("word_bpe_49k.json"), outputs=("ids_sha256", "decoded_sha256"))


@query
def op9_sharding(spark, folder):
    """Every document in one of 16 shards of equal row counts, at a uniformly random slot."""
    rows = sharding.shard_documents(table(spark, folder, "documents"))
    return rows.withColumns({"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")})


@query
def op10_decontamination(spark, folder):
    """Each document and test item that match within the error budget, and how closely."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    marked = decontamination.contamination(docs, table(spark, folder, "benchmark"))
    return marked.select("doc_id", F.explode("matches").alias("m")).select(
        "doc_id", F.col("m.item").alias("item_id"), "m.edits", "m.first_word", "m.words"
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: in about every tenth document (by checksum of the id) a periodic end replaces the words."""
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8"))
    g = F.floor(h / 10).cast("long")

    def planted(words):
        n = F.size(words).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("long")
        source = F.struct(words.alias("w"), a.alias("a"), p.alias("p"))
        return let(
            source,
            lambda s: F.transform(
                s["w"],
                lambda w, i: F.when(i < s["a"], w).otherwise(
                    F.get(s["w"], (s["a"] + F.pmod(i - s["a"], s["p"])).cast("int"))
                ),
            ),
        )

    changed = let(words_of(F.col("text")), lambda w: F.when(F.size(w) > 0, F.array_join(planted(w), " ")).otherwise(""))
    text = F.when((F.pmod(h, F.lit(10)) == 0) & F.col("text").isNotNull(), changed).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


@query
def op11_periodic_runs(spark, folder):
    """Runs of periodic words of each document, the one of most periods, and what is left when repeats go."""
    docs = with_planted_runs(table(spark, folder, "documents"))
    found = periodic_runs.find_runs(docs).select("doc_id", "periodic.*")
    more = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]
    rest = F.slice("runs", 2, F.greatest(F.size("runs") - 1, F.lit(0)))
    first = F.get("runs", F.lit(0))
    best = F.aggregate(rest, first, lambda a, b: F.when(more(a, b), b).otherwise(a))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    listed = F.array_join(F.transform("runs", line), "")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.alias("_best"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        "_best.*",
        F.floor(F.col("_best.length") * 1000 / F.col("_best.period")).cast("long").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


@query
def op13_substring_dedup(spark, folder):
    """What is left of each document without windows of 50 words that also start in a document of smaller id."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    left = substring_dedup.strip_repeats(docs)
    return left.select(
        "doc_id", "repeats.n_words", "repeats.n_removed", F.sha2("repeats.kept", 256).alias("kept_sha256")
    )


ORACLE_SQL["op13_substring_dedup"] = r"""
with w as (select doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as words from documents),
spots as (select doc_id, words, unnest(range(1, len(words) - 48)) as i from w where len(words) >= 50),
windows as (select doc_id, i, array_to_string(words[i:i + 49], ' ') as win from spots),
least as (select win, min(doc_id) as low from windows group by win having min(doc_id) < max(doc_id)),
repeated as (select doc_id, i from windows join least using (win) where low < doc_id),
gone as (select distinct doc_id, unnest(range(i, i + 50)) as spot from repeated),
dropped as (select doc_id, list(spot) as ats from gone group by doc_id),
marked as (select w.doc_id, words, coalesce(ats, []) as ats from w left join dropped using (doc_id)),
split as (select doc_id, words, unnest(range(1, len(words) + 1)) as spot from marked where len(ats) > 0),
rest as (select s.doc_id, string_agg(s.words[s.spot], ' ' order by s.spot) as kept
  from split s anti join gone g on s.doc_id = g.doc_id and s.spot = g.spot group by s.doc_id)
select m.doc_id, len(words)::bigint as n_words, len(ats)::bigint as n_removed,
  sha256(case when len(ats) = 0 then array_to_string(words, ' ') else coalesce(kept, '') end) as kept_sha256
from marked m left join rest using (doc_id)
"""


@query
def op12_filter_audit(spark, folder):
    """What each of five filters removes of each source, at every step of every order of them."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return filter_audit.audit(filter_audit.mask_counts(docs, table(spark, folder, "labels")))


ORACLE_SQL["op12_filter_audit"] = r"""
with d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
firsts as (select text, min(doc_id) as low from d group by text),
good as (select distinct doc_id from labels where quality = 1),
bad as (select distinct doc_id from labels where toxic = 1),
masks as (select part,
    (case when len(words) < 200 then 1 else 0 end)
    + (case when 100 * len(list_distinct(words)) < 50 * len(words) then 2 else 0 end)
    + (case when 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) then 4 else 0 end)
    + (case when regexp_matches(text, '[#$%&*|]') then 8 else 0 end)
    + (case when low < d.doc_id then 16 else 0 end) as mask,
    g.doc_id is not null as good, b.doc_id is not null as bad
  from d join firsts using (text) left join good g on g.doc_id = d.doc_id left join bad b on b.doc_id = d.doc_id),
counts as (select part, mask, count(*) as n, count_if(good) as n_good, count_if(bad) as n_toxic from masks group by part, mask),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as c, unnest([1, 2, 4, 8, 16]) as b),
orders as (select p.c || q.c || r.c || s.c || t.c as filter_order, [p.b, q.b, r.b, s.b, t.b] as bits
  from letters p join letters q on q.c <> p.c join letters r on r.c not in (p.c, q.c)
  join letters s on s.c not in (p.c, q.c, r.c) join letters t on t.c not in (p.c, q.c, r.c, s.c)),
steps as (select filter_order, step, bits[step] as bit, coalesce(list_sum(bits[1:step - 1]), 0)::bigint as earlier
  from orders, (select unnest([1, 2, 3, 4, 5]) as step))
select part, filter_order, step::int as step,
  sum(case when mask & (bit | earlier) = 0 then n else 0 end)::bigint as kept,
  sum(case when mask & bit <> 0 and mask & earlier = 0 then n else 0 end)::bigint as removed,
  sum(case when mask & bit <> 0 and mask & earlier <> 0 then n else 0 end)::bigint as redundant,
  sum(case when mask = bit then n else 0 end)::bigint as unique_fails,
  sum(case when mask & bit <> 0 and mask & earlier = 0 then n_good else 0 end)::bigint as good_lost,
  sum(case when mask & bit <> 0 and mask & earlier = 0 then n_toxic else 0 end)::bigint as toxic_lost,
  sum(case when mask & bit <> 0 then n * 120 // bit_count(mask) else 0 end)::bigint as shapley
from counts, steps group by part, filter_order, step, bit, earlier
"""
