"""Personal data by weak supervision, in built-in expressions only.

Candidates are found by patterns: four kinds (email, ip, card, phone) in their plain form, and looser forms (written-out
addresses, bracketed dots, numbers grouped like telephone numbers). Labelers vote on each candidate: patterns, word lists
(gazetteers) and the words before it (context) say personal (+1), not personal (-1) or nothing (0).
Expectation-maximisation over the vote patterns of the whole corpus estimates how reliable each labeler is and
how likely each pattern is personal. Those probabilities are the soft labels of the final span classifier, a naive
Bayes model over features of the span and its surroundings. Plain matches that pass their fixed check always stay;
the classifier adds others.

The votes are counted by pattern in Spark, so each step of the estimation is one aggregate over at most
3 ** labelers rows, and the model is a few dozen numbers. Documents are read twice: to learn and to mark.

Spans count code points, end exclusive. Defined cases: a NULL text is empty; an empty text has no span; equal rows get
equal spans; an empty corpus gives the model of the priors alone. Other columns are kept.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmill.llm.common import let, text_of
from shopmill.operators.scale import durable

KINDS = ("email", "ip", "card", "phone")
TOLERANCE = 1e-4  # estimation ends when no probability moves by more
MOST_STEPS = 300  # ends it in any case
ACCEPT = 0.9
PRIOR_VOTES = 20.0  # pseudo-votes that anchor each labeler at ``PRIOR_TRUST``
PRIOR_TRUST = 0.85
BLOCK = 256

# Fixed patterns of the contract, written so that a match is found without going back over a run twice.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

AT = r"(?:\[at\]|\(at\)|\{at\}|@)"
DOT = r"(?:\[dot\]|\(dot\)|\{dot\}|\[\.\]|\.)"
LOOSE_EMAIL = rf"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?{AT}\x20?[A-Za-z0-9-]++(?:\x20?{DOT}\x20?[A-Za-z0-9-]{{2,}}+)++"
LOOSE_IP = r"(?<![0-9.])[0-9]{1,3}(?:\[\.\]|\(\.\)|\[dot\])[0-9]{1,3}(?:\[?\.\]?|\(\.\)|\[dot\])[0-9]{1,3}(?:\[?\.\]?|\(\.\)|\[dot\])[0-9]{1,3}(?![0-9.])"
LOOSE_PHONE = r"(?<![0-9+.,-])(?:\([0-9]{2,5}\)\x20?|[0-9]{2,5}[\x20./-])(?:[0-9]{2,5}[\x20./-]){0,3}[0-9]{3,5}(?![0-9.,-]?[0-9])"

# Cheap tests that a text can hold a match at all.
MAYBE = {
    EMAIL: lambda t: F.contains(t, F.lit("@")),
    IP: lambda t: F.rlike(t, F.lit(r"[0-9]\.[0-9]")),
    CARD: lambda t: F.rlike(t, F.lit(r"[0-9](?:[\x20-]?[0-9]){12}")),
    PHONE: lambda t: F.contains(t, F.lit("+")),
    LOOSE_EMAIL: lambda t: F.rlike(t, F.lit(r"(?i)[\[({](?:at|dot|\.)[\])}]|@\x20")),
    LOOSE_IP: lambda t: F.rlike(t, F.lit(r"(?i)[0-9][\[(](?:\.|dot)[\])][0-9]")),
    LOOSE_PHONE: lambda t: F.rlike(t, F.lit(r"[0-9][)\x20./-]{1,2}[0-9]{2,5}[\x20./-]?[0-9]{2}")),
}

# Gazetteers and context words.
ENDINGS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu")
CONTACT = r"\b(?:phone|tel|telephone|telefon|téléphone|teléfono|call|mobile|cell|fax|contact|whatsapp|sms|mail|e-mail|email|correo|address|reach|card|visa|credit|account|ssn|ip)\b[^\n]{0,12}$"
COUNTED = r"\b(?:isbn|issn|issue|version|page|pages|chapter|order|year|no|number|id|ref|section|line|figure|table|vol)\b[^\n]{0,6}$"
UNITS = r"^\x20?(?:%|km|kg|cm|mm|mb|gb|eur|usd|euros?|dollars?|years?|pages?|people|times|€|\$)"
CALLING = ("1", "33", "34", "39", "41", "43", "44", "49", "52", "54", "55", "61", "81", "86", "91")

LABELERS = ("shape", "check", "ending", "contact", "counted", "units", "calling", "edges")


def running(lengths: Column) -> Column:
    """Exclusive running sums of an array of ints, block by block to stay near linear."""
    zero = F.struct(F.array().cast("array<int>").alias("a"), F.lit(0).alias("s"))

    def sums(values: Column) -> Column:
        step = lambda acc, x: F.struct(
            F.concat(acc["a"], F.array(acc["s"])).alias("a"), (acc["s"] + x).alias("s")
        )
        return F.aggregate(values, zero, step)

    def whole(blocks: Column) -> Column:
        inner = F.transform(blocks, sums)
        return let(
            inner,
            lambda parts: F.flatten(
                F.zip_with(
                    F.transform(parts, lambda p: p["a"]),
                    sums(F.transform(parts, lambda p: p["s"]))["a"],
                    lambda a, o: F.transform(a, lambda x: x + o),
                )
            ),
        )

    count = F.size(lengths)
    starts = F.sequence(F.lit(1), F.greatest(count, F.lit(1)), F.lit(BLOCK))
    return let(F.transform(starts, lambda s: F.slice(lengths, s, F.lit(BLOCK))), whole)


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, found) of the leftmost non-overlapping matches of ``pattern``."""
    none = F.array().cast("array<struct<start:int,end:int,found:string>>")

    def placed(found: Column) -> Column:
        between = F.transform(F.split(text, pattern, -1), F.char_length)
        own = F.transform(found, lambda f: F.char_length(f))
        steps = F.transform(own, lambda n, i: n + F.get(between, i + 1))
        first = F.get(between, F.lit(0))
        return F.zip_with(
            found,
            running(steps),
            lambda f, s: F.struct(
                (first + s).alias("start"), (first + s + F.char_length(f)).alias("end"), f.alias("found")
            ),
        )

    some = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)
    return F.when(MAYBE[pattern](text), some).otherwise(none)


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _valid(kind: str, found: Column) -> Column:
    """The fixed check of a plain match."""
    n = F.char_length(_digits(found))
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = lambda p: let(
            F.regexp_replace(p, "^0+", ""),
            lambda d: (F.char_length(d) <= 3) & (F.coalesce(F.try_to_number(d, F.lit("999")), F.lit(0)) <= 255),
        )
        return F.forall(F.split(found, r"\."), part)
    if kind == "card":
        return (n >= 13) & (n <= 19) & F.call_function("luhn_check", _digits(found))
    return (n >= 9) & (n <= 15)


def _cards(found: Column) -> Column:
    """Whether digits are one card number, or several with a space between."""
    return _valid("card", found) | F.forall(F.split(found, " "), lambda p: _valid("card", p))


def plain_spans(text: Column) -> Column:
    """Array of (kind, start, end, found, base) of all plain matches, kinds in order; ``base`` if the check holds."""

    def of(kind: str, pattern: str) -> Column:
        return F.transform(
            matches(text, pattern),
            lambda m: F.struct(
                F.lit(kind).alias("kind"),
                m["start"].alias("start"),
                m["end"].alias("end"),
                m["found"].alias("found"),
                _valid(kind, m["found"]).alias("base"),
            ),
        )

    return F.concat(*[of(k, p) for k, p in zip(KINDS, (EMAIL, IP, CARD, PHONE))])


def _overlaps(spans: Column, s: Column) -> Column:
    return F.exists(spans, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"]))


def candidates(text: Column) -> Column:
    """All plain matches that matter and looser ones clear of the certain spans."""

    def loose(kind: str, pattern: str) -> Column:
        return F.transform(
            matches(text, pattern),
            lambda m: F.struct(
                F.lit(kind).alias("kind"),
                m["start"].alias("start"),
                m["end"].alias("end"),
                m["found"].alias("found"),
                F.lit(False).alias("base"),
            ),
        )

    def both(plain: Column) -> Column:
        sure = F.filter(plain, lambda s: s["base"])
        more = F.concat(
            loose("email", LOOSE_EMAIL),
            loose("ip", LOOSE_IP),
            loose("phone", LOOSE_PHONE),
            F.filter(plain, lambda s: ~s["base"] & (F.char_length(_digits(s["found"])) >= 7)),
        )
        return let(
            sure,
            lambda sure: F.concat(sure, F.filter(more, lambda s: ~_overlaps(sure, s))),
        )

    return let(plain_spans(text), both)


def described(text: Column, span: Column) -> Column:
    """Struct of the votes (in the order of ``LABELERS``) and the active features (ids) of a span."""
    found, kind = span["found"], span["kind"]
    before = F.lower(F.substring(text, F.greatest(span["start"] - 39, F.lit(1)), F.least(span["start"], F.lit(40))))
    after = F.lower(F.substring(text, span["end"] + 1, F.lit(12)))

    def of(c: Column) -> Column:
        digits = c["digits"]
        n = F.char_length(digits)
        vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
        never = F.lit(False)
        shape = vote(
            F.when(kind == "email", F.lit(True))
            .when(kind == "ip", F.forall(F.split(F.regexp_replace(found, r"[^0-9.]", ""), r"\."), lambda p: F.char_length(p) <= 3))
            .when(kind == "card", F.rlike(found, F.lit(r"^(?:[0-9]{4}[ -]){3}[0-9]{1,7}$")))
            .otherwise(F.rlike(found, F.lit(r"^(?:\+|\([0-9]{3}\)|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}$)"))),
            (kind == "phone") & ((n < 7) | (n > 15)) | F.rlike(found, F.lit(r"^(?:19|20)[0-9]{2}[./-][0-9]{1,2}[./-]")),
        )
        check = F.when(kind == "card", F.when(c["card"], 1).otherwise(-1)).when(
            kind == "ip", F.when(_valid("ip", F.regexp_replace(F.regexp_replace(found, r"(?i)dot", "."), r"[^0-9.]", "")), 1).otherwise(-1)
        ).otherwise(0)
        ending = F.when(
            kind == "email",
            vote(F.lower(F.regexp_extract(found, "([A-Za-z]+)$", 1)).isin(*ENDINGS), F.rlike(found, F.lit(r"[0-9]$"))),
        ).otherwise(0)
        contact = vote(F.rlike(c["before"], F.lit(CONTACT)), never)
        counted = vote(never, F.rlike(c["before"], F.lit(COUNTED)))
        units = vote(never, F.rlike(c["after"], F.lit(UNITS)))
        calling = F.when(
            kind == "phone",
            vote(
                F.startswith(found, F.lit("+")) & F.regexp_extract(found, r"^\+([0-9]{1,3})[ (.-]", 1).isin(*CALLING),
                ~F.startswith(found, F.lit("+")) & F.startswith(found, F.lit("0000")),
            ),
        ).otherwise(0)
        edges = vote(never, F.rlike(c["before"], F.lit(r"[A-Za-z0-9#/=_]$")) | F.rlike(c["after"], F.lit(r"^[A-Za-z0-9_/=]")))
        votes = [shape, check, ending, contact, counted, units, calling, edges]
        bucket = F.when(n < 7, 0).when(n < 9, 1).when(n < 13, 2).when(n < 20, 3).otherwise(4)
        which = F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind).cast("int") - 1
        flags = [
            F.rlike(found, F.lit("[()]")),
            F.rlike(found, F.lit(" ")),
            F.rlike(found, F.lit("-")),
            F.rlike(found, F.lit(r"\.")),
            F.startswith(found, F.lit("+")),
            F.contains(found, F.lit("@")),
            (kind == "card") & c["card"],
            F.rlike(c["before"], F.lit(CONTACT)),
            F.rlike(c["before"], F.lit(COUNTED)),
            F.rlike(c["after"], F.lit(UNITS)),
            F.rlike(c["before"], F.lit(r"[A-Za-z0-9#/=_]$")),
            F.rlike(c["after"], F.lit(r"^[A-Za-z0-9_/=]")),
        ]
        active = [which * 5 + bucket] + [F.when(f, 20 + 2 * i).otherwise(21 + 2 * i) for i, f in enumerate(flags)]
        return F.struct(F.array(*[v.cast("int") for v in votes]).alias("votes"), F.array(*active).alias("active"))

    return let(
        F.struct(
            _digits(found).alias("digits"),
            before.alias("before"),
            after.alias("after"),
            _cards(found).alias("card"),
        ),
        of,
    )


FEATURE_IDS = 20 + 2 * 12


class Model(NamedTuple):
    """Log-odds of the classifier: a prior and one weight for each feature id; and the labelers' reliabilities."""

    bias: float
    weights: tuple[float, ...]
    reliability: dict[str, dict[int, tuple[float, float]]]  # vote -> share if personal, share if not


def estimate(
    patterns: DataFrame, tolerance: float = TOLERANCE, most: int = MOST_STEPS
) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """Expectation-maximisation over ``votes, n`` (one row a vote pattern): prior and vote shares by class.

    It ends when neither the prior nor a share moves by more than ``tolerance`` in a step.
    """
    votes = (-1, 0, 1)
    start = {1: (PRIOR_TRUST, 1 - PRIOR_TRUST), -1: (1 - PRIOR_TRUST, PRIOR_TRUST), 0: (0.5, 0.5)}
    shares = [{v: (start[v][0], start[v][1]) for v in votes} for _ in LABELERS]
    prior = 0.5
    here = {(i, v): F.get("votes", F.lit(i)) == v for i in range(len(LABELERS)) for v in votes}
    for _ in range(most):
        was = [prior, *(p for s in shares for pair in s.values() for p in pair)]
        scored = patterns.select("votes", "n", _probability(prior, shares).alias("p"))
        yes, no = F.col("n") * F.col("p"), F.col("n") * (1 - F.col("p"))
        sums = [F.sum(yes).alias("y"), F.sum(no).alias("n")]
        for (i, v), voted in here.items():
            sums.append(F.sum(F.when(voted, yes).otherwise(0.0)).alias(f"y{i}_{v + 1}"))
            sums.append(F.sum(F.when(voted, no).otherwise(0.0)).alias(f"n{i}_{v + 1}"))
        row = scored.agg(*sums).first()  # a fixed number of sums
        if row["y"] is None:
            break
        prior = min(max((row["y"] + 1) / (row["y"] + row["n"] + 2), 1e-3), 1 - 1e-3)
        for i in range(len(LABELERS)):
            scale = [PRIOR_VOTES * sum(s[k] for s in start.values()) for k in (0, 1)]
            shares[i] = {
                v: (
                    (row[f"y{i}_{v + 1}"] + PRIOR_VOTES * start[v][0]) / (row["y"] + scale[0]),
                    (row[f"n{i}_{v + 1}"] + PRIOR_VOTES * start[v][1]) / (row["n"] + scale[1]),
                )
                for v in votes
            }
        now = [prior, *(p for s in shares for pair in s.values() for p in pair)]
        if max(abs(a - b) for a, b in zip(was, now)) <= tolerance:
            break
    return prior, shares


def _probability(prior: float, shares: list[dict[int, tuple[float, float]]]) -> Column:
    """Probability that a row with ``votes`` is personal; an abstention says nothing.

    The numbers stand in one array, which generated code refers to, so every step runs the code compiled for the first.
    """
    weights = [math.log(prior / (1 - prior))]
    for s in shares:
        weights += [math.log(s[-1][0] / s[-1][1]), 0.0, math.log(s[1][0] / s[1][1])]
    table = F.lit(weights)
    total = F.get(table, F.lit(0))
    for i in range(len(shares)):
        total = total + F.get(table, F.get("votes", F.lit(i)) + (3 * i + 2))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(docs: DataFrame, text: str = "text") -> Model:
    """Learn from every candidate of every text."""
    whole = text_of(text)
    found = let(whole, lambda t: let(candidates(t), lambda c: F.transform(c, lambda s: described(t, s))))
    # Votes and features of a span repeat; their combinations are few and bounded.
    counted = durable(
        docs.select(F.explode(found).alias("d")).select("d.*").groupBy("votes", "active").agg(F.count("*").alias("n"))
    )
    prior, shares = estimate(durable(counted.groupBy("votes").agg(F.sum("n").alias("n")).coalesce(1)))  # at most 3 ** labelers rows
    soft = counted.withColumn("p", _probability(prior, shares))
    soft = soft.select("n", "p", F.explode("active").alias("id"))
    rows = soft.groupBy("id").agg(F.sum(F.col("n") * F.col("p")).alias("y"), F.sum(F.col("n") * (1 - F.col("p"))).alias("m"))
    by_id = {r["id"]: (r["y"], r["m"]) for r in rows.collect()}  # at most FEATURE_IDS rows
    yes = sum(by_id.get(i, (0, 0))[0] for i in range(20))
    no = sum(by_id.get(i, (0, 0))[1] for i in range(20))

    def weight(i: int) -> float:
        y, m = by_id.get(i, (0.0, 0.0))
        return math.log((y + 1) / (yes + 2)) - math.log((m + 1) / (no + 2))

    return Model(
        math.log((yes + 1) / (no + 1)), tuple(weight(i) for i in range(FEATURE_IDS)), dict(zip(LABELERS, shares))
    )


def mark(docs: DataFrame, model: Model, text: str = "text", out: str = "spans", accept: float = ACCEPT) -> DataFrame:
    """``docs`` with ``out``: array of (kind, start, end, base, p) by kind as in ``KINDS``, then start.

    Base spans stay whatever their probability; others need ``accept``. A column already named ``out`` is replaced.
    """
    weights = F.array(*[F.lit(w) for w in model.weights])

    def scored(t: Column) -> Column:
        def one(s: Column) -> Column:
            total = F.aggregate(
                described(t, s)["active"], F.lit(model.bias), lambda a, i: a + F.get(weights, i)
            )
            return F.struct(
                F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"]).alias("order"),
                s["start"].alias("start"),
                s["end"].alias("end"),
                s["kind"].alias("kind"),
                s["base"].alias("base"),
                (F.lit(1.0) / (F.lit(1.0) + F.exp(-total))).alias("p"),
            )

        kept = F.filter(F.transform(candidates(t), one), lambda s: s["base"] | (s["p"] >= accept))
        return F.transform(
            F.array_sort(F.array_distinct(kept)),
            lambda s: F.struct(*[s[c].alias(c) for c in ("kind", "start", "end", "base", "p")]),
        )

    return docs.withColumn(out, let(text_of(text), scored))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` joined by commas, in the order of the array."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
