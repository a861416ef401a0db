"""Secret scans: assignment-aware lexing of source and configuration text.

A text is lexed into statements ``name <operator> expression``; expressions are quoted literals, bare
literals, references to other names, or sums of these. Names bound to literals are constants, and a
reference to a constant carries its literals to the name it is assigned to. Each literal is scored by the most
sensitive name it reaches times how much it looks like a credential; from ``threshold`` on it is reported.
Three fixed patterns (credential assignments, access key ids, long hex runs) are always reported. A credential
assignment that stops inside its value is reported as a literal of the whole value as well: up to the closing quote, or,
unquoted, up to white space, a quote, a bracket, a comma or a semicolon. Any other literal is left out only where one of
these spans holds all of it, so it may overlap them.

Spans count code points, end exclusive. Texts are scanned whole. Defined cases: a NULL text is
empty; an empty text has no span; equal rows give equal spans; a name assigned twice keeps both values; cyclic references end.
Other columns are kept.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopmill.llm.common import text_of

KINDS = ("assign", "access", "hex", "literal")
THRESHOLD = 0.5
SPANS = "array<struct<kind:string,start:int,end:int,base:boolean,name:string,score:double>>"

# Fixed patterns of the contract.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
QUOTED_REST = {q: re.compile(rf"(?:[^{q}\\\n]|\\.)*+(?={q})") for q in "\"'"}
BARE_REST = re.compile(r"""[^\s"'`,;()\[\]{}<>]*+""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # every run of hex digits of at least 24
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")

#: Parts of names and how sensitive they make a name; adjacent parts count joined as well.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 1.0, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "accesskey": 1.0, "privatekey": 1.0, "secretkey": 1.0, "authkey": 1.0,
    "signingkey": 1.0, "encryptionkey": 1.0, "sharedkey": 0.9, "accountkey": 0.9,
    "credential": 0.9, "credentials": 0.9, "bearer": 0.9, "authorization": 0.8, "jwt": 0.8,
    "connectionstring": 0.7, "pass": 0.7, "auth": 0.6, "salt": 0.6, "key": 0.5,
}
STEMS = tuple(sorted({s for s in SENSITIVE if len(s) < 8} | {"credential", "phrase", "private", "connection"}))
DUMMY = re.compile(r"x{4,}|\*{3,}|\.{3,}|change.?me|example|your|dummy|null|none|true|false|todo", re.I)
HOLES = (("<", ">"), ("${", "}"), ("{{", "}}"))  # a placeholder between two signs

# Possessive throughout: a text of any length is lexed in linear time without a cap.
_NAME = r"[A-Za-z_][A-Za-z0-9_]*+(?:[.\-][A-Za-z0-9_]++)*+"
_STRING = r'"(?:[^"\\\n]|\\.)*+"|' + r"'(?:[^'\\\n]|\\.)*+'"
_BARE = r"[A-Za-z0-9+/_.=$@!%^&*~{}-]"
STATEMENT = re.compile(rf"""(?<![A-Za-z0-9_.\-])["']?({_NAME})["']?[ \t]*+(=>|:=|=(?!=)|:)[ \t]*+(?={_STRING}|{_BARE})""")
NAME, QUOTED, BARE = re.compile(_NAME), re.compile(_STRING), re.compile(_BARE + "++")
JOINED = re.compile(r"[ \t]*+\+[ \t]*+")
LINE_START = re.compile(r"[ \t]*+(?:(?:export|set|const|let|var|final|static|public|private|val|def|-)[ \t]++)*+")
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def sensitivity(name: str) -> float:
    parts = [p.lower() for p in PARTS.findall(name)]
    joined = parts + [a + b for a, b in zip(parts, parts[1:])]
    return max((SENSITIVE.get(p, 0.0) for p in joined), default=0.0)


def credibility(value: str) -> float:
    """How much a literal looks like a credential: length, spread of its characters, no placeholder."""
    if len(value) < 6 or any(c.isspace() for c in value) or DUMMY.search(value):
        return 0.0
    if any(a in value and value.index(a) + len(a) <= value.rfind(b) for a, b in HOLES):
        return 0.0
    counts = Counter(value)
    entropy = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    kinds = sum(any(f(c) for c in value) for f in (str.islower, str.isupper, str.isdigit))
    kinds += any(not c.isalnum() for c in value)
    return min(1.0, entropy / 3.0) * (1.0 if kinds >= 2 else 0.6)


class Statement:
    def __init__(self, name: str, literals: list, references: list[str]):
        self.name, self.literals, self.references = name, literals, references


def lex(text: str) -> list[Statement]:
    """Name-literal statements; a literal is (start, end, value), its quotes left out."""
    found, line, head, seen, run = [], 0, -1, 0, 0
    for m in STATEMENT.finditer(text):
        line, seen = max(line, text.rfind("\n", seen, m.start()) + 1), m.start()
        if head < line:  # the first statement of its line: where the words that may open it end
            head = LINE_START.match(text, line).end()
        opens_line = m.start() <= head and bool(LINE_START.fullmatch(text, line, m.start()))
        literals, references, at = [], [], m.end()
        while True:
            if quoted := QUOTED.match(text, at):
                end = quoted.end()
                literals.append((at + 1, end - 1, text[at + 1 : end - 1]))
            elif BARE.match(text, at, at + 1):
                if run <= at:  # terms of one run end together
                    run = BARE.match(text, at).end()
                end = run
                if NAME.fullmatch(text, at, end):
                    references.append(text[at:end])
                if opens_line:  # a bare word may be a value as well, as in key: value files
                    literals.append((at, end, text[at:end]))
            else:
                break
            plus = JOINED.match(text, end)
            if not plus:
                break
            at = plus.end()
        found.append(Statement(m[1], literals, references))
    return found


def propagate(statements: list[Statement]) -> dict[tuple[int, int, str], tuple[str, float]]:
    """Each literal with the most sensitive name it reaches through references, and that name's weight."""
    reach: dict[str, tuple[str, float]] = {}
    readers: dict[str, set[str]] = {}
    for s in statements:
        reach[s.name] = (s.name, sensitivity(s.name))
        for r in s.references:
            readers.setdefault(r, set()).add(s.name)
    todo = [n for n, (_, w) in reach.items() if w > 0]
    sources: dict[str, set[str]] = {}
    for source, names in readers.items():
        for n in names:
            sources.setdefault(n, set()).add(source)
    while todo:  # weights only rise, so cycles end
        name = todo.pop()
        for source in sources.get(name, ()):
            if source in reach and reach[source][1] < reach[name][1]:
                reach[source] = reach[name]
                todo.append(source)
    best: dict[tuple[int, int, str], tuple[str, float]] = {}
    for s in statements:
        for literal in s.literals:
            if literal[2] not in reach and reach[s.name][1] > best.get(literal, ("", 0.0))[1]:
                best[literal] = reach[s.name]
    return best


def values(text: str, assigned: list[re.Match]) -> dict[tuple[int, int], str]:
    """The whole values (start, end) that credential assignments stop inside of, with their names."""
    found, run = {}, 0
    for m in assigned:
        quote = QUOTED_REST.get(text[m.start(2) - 1])
        rest = quote.match(text, m.end()) if quote else None
        if rest:
            end = rest.end()
        else:
            if run < m.end():  # values of one run end together
                run = BARE_REST.match(text, m.end()).end()
            end = run
        if end > m.end():
            found[m.start(2), end] = m[1]
    return found


def spans(text: str, threshold: float = THRESHOLD) -> list[tuple]:
    """(kind, start, end, base, name, score) by start, then kind as in KINDS."""
    found, whole = [], {}
    lower = text.lower()
    if any(w in lower for w in ASSIGN_WORDS):
        assigned = [m for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        found = [("assign", m.start(), m.end(), True, m[1], 1.0) for m in assigned]
        whole = values(text, assigned)
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= 20:
                found.append(("access", m.start(), m.end(), True, "", 1.0))
    found += [("hex", m.start(), m.end(), True, "", 1.0) for m in HEX.finditer(text)]
    found += [("literal", start, end, False, name, 1.0) for (start, end), name in whole.items()]
    if ("=" in text or ":" in text) and any(s in lower for s in STEMS):
        taken = sorted((s, e) for _, s, e, *_ in found)
        starts, reach = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))
        for (start, end, value), (name, weight) in propagate(lex(text)).items():
            score = weight * credibility(value)
            before = bisect_right(starts, start)
            held = before and end <= reach[before - 1]  # by the span that reaches farthest
            if score >= threshold and not held:
                found.append(("literal", start, end, False, name, round(score, 6)))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan(docs: DataFrame, text: str = "text", out: str = "secrets", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``out``, the array of spans. A column already named ``out`` is replaced."""

    @F.pandas_udf(SPANS)
    def search(texts: pd.Series) -> pd.Series:
        return pd.Series([spans(t, threshold) for t in texts])

    return docs.withColumn(out, search(text_of(text)))


def span_list(found: Column) -> Column:
    """``kind:start:end`` joined by commas, in the order of the array."""
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def mask(text: str, found: str, sign: str = "[SECRET]") -> Column:
    """The text with every reported stretch replaced by ``sign``; overlapping ones become one."""

    @F.pandas_udf("string")
    def replace(texts: pd.Series, spans: pd.Series) -> pd.Series:
        masked = []
        for t, found in zip(texts, spans):
            if t is None:  # nothing to mask; these rows come here all the same
                masked.append(None)
                continue
            parts, at, last = [], 0, None
            for s in sorted(found, key=lambda s: (s["start"], s["end"])):
                if last is None or s["start"] >= last:
                    parts += [t[at : s["start"]], sign]
                at = last = max(at, s["end"])
            masked.append("".join([*parts, t[at:]]))
        return pd.Series(masked)

    some = F.size(found) > 0
    return F.when(some, replace(F.when(some, F.col(text)), F.col(found))).otherwise(F.col(text))
