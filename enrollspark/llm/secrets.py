"""Secret scans: patterns, and values in credential contexts weighed by a guess-cost dynamic programme.

A value that stands where a credential stands (``password = ...``, ``pwd: ...``, a URL's
user part) is cut into words, dates, repeats, keyboard walks and brute-force
characters so that the guesses an attacker needs are fewest. A value that still
needs ``10 ** LEAST_LOG10`` guesses is a secret; a placeholder such as
``changeme`` or a word of the text itself is not. The text's own words stand between white
space, in letters of one case but for the first; a run of letters within a code is none.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from enrollspark.llm.common import private, text_or_empty

KINDS = ("assign", "access", "hex", "guess")
BASE_KINDS = KINDS[:3]
LEAST_LOG10 = 10.0
LEAST_VALUE = 6

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
# runs of the class are maximal either way, so a least length in the pattern drops the same matches
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|auth|bearer|(?:api|access|private|client)[_-]?(?:key|secret))["']?[\x20\t]*(?:[:=]|=>|:=)[\x20\t]*["'`]?([^\x20\x09-\x0D"'`,;<>]{6,})""",
    re.IGNORECASE | re.ASCII,
)
HEAD = 24  # characters that a context has before its value, blanks left out: as many at most
BEARER = re.compile(r"""(?<![a-z])bearer[\x20\t]+["'`]?(?![:=])([^\x20\x09-\x0D"'`,;<>]{6,})""", re.IGNORECASE | re.ASCII)
CONTEXT_HINTS = ("pass", "pwd", "secret", "token", "credential", "auth", "bearer", "key")
USER_PART = re.compile(r"://[^\x20\x09-\x0D:/@]+:([^\x20\x09-\x0D/@]{6,})@")

# Words that are tried first, likeliest first.
COMMON = (
    "password passwd pass secret token admin administrator root user login welcome qwerty letmein changeme change "
    "default example sample test testing dummy placeholder your yours mysecret key apikey api none null undefined empty "
    "hello world love monkey dragon master shadow sunshine princess football baseball superman batman iloveyou trustno "
    "access private public client server host local localhost prod production staging develop developer demo guest "
    "redacted hidden masked replace insert value string here enter the and for with from this that name mail email "
    "company service account database data system computer internet summer winter spring autumn monday january "
    "michael jordan thomas daniel jessica charlie andrew joshua robert matthew jennifer ashley nicole hunter"
).split()
WALKS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "1qaz", "2wsx", "3edc", "4rfv", "5tgb", "6yhn", "7ujm", "abcdefghijklmnopqrstuvwxyz", "0123456789")
LEET = str.maketrans("4@831!0$57", "aabeiiosst")
DATE = re.compile(r"(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01]))?|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d")
WORD = re.compile(r"[a-z]{4,24}|[A-Z][a-z]{3,23}|[A-Z]{4,24}")
EDGES = ".,;:!?\"'`()[]{}<>*_-"

LONGEST_WORD, LEAST_WORD, LONGEST_BLOCK, LEAST_WALK = 24, 3, 8, 3
SEGMENT = math.log10(2)  # for where a segment ends
NEXT_KEY = {(a, b) for row in WALKS for x, y in zip(row, row[1:]) for a, b in ((x, y), (y, x))}


def _class_cost(c: str) -> float:
    return math.log10(10 if c.isdigit() else 26 if c.isalpha() and c.isascii() else 33 if c.isascii() else 128)


def guess_cost(value: str, ranks: dict[str, int]) -> float:
    """log10 of the fewest guesses over all segmentations; ``ranks`` gives the place of a known lower-case word."""
    n, low = len(value), value.lower()
    if len(low) != n:  # lower case may be longer for a few letters
        low = "".join(c.lower()[:1] or c for c in value)
    plain = low.translate(LEET)
    one = [_class_cost(c) for c in value]
    total = [0.0]
    for x in one:
        total.append(total[-1] + x)
    # from the right: how far characters repeat those p places on, and where a keyboard walk ends
    again = {p: [0] * (n + 1) for p in range(1, LONGEST_BLOCK + 1)}
    walk, turns = [n] * (n + 1), [0] * (n + 3)
    for i in range(n - 1, -1, -1):
        for p, run in again.items():
            if i + p < n and low[i] == low[i + p]:
                run[i] = run[i + 1] + 1
        walk[i] = walk[i + 1] if i + 1 < n and (low[i], low[i + 1]) in NEXT_KEY else i + 1
        turns[i] = turns[i + 1] + (i >= 2 and low[i] == low[i - 2])
    best = [0.0] + [math.inf] * n
    for i in range(n):
        at = best[i]
        spans: list[tuple[int, float]] = [(i + 1, one[i] - SEGMENT)]
        for k in range(i + LEAST_WORD, min(n, i + LONGEST_WORD) + 1):
            r, extra = ranks.get(low[i:k]), 0.0
            if r is None and (r := ranks.get(plain[i:k])) is not None:
                extra = math.log10(4)
            if r is not None:
                spans.append((k, math.log10(r + 1) + extra + (0.0 if value[i:k] == low[i:k] else math.log10(2))))
        if m := DATE.match(value, i):
            spans.append((m.end(), math.log10(130 * (366 if m.end() - i > 4 else 1))))
        for p, run in again.items():
            if run[i] >= p:
                times = 1 + run[i] // p
                spans.append((i + times * p, total[i + p] - total[i] + math.log10(times)))
        k = walk[i]
        if k - i >= LEAST_WALK:
            spans.append((k, math.log10(47 * 4 * (k - i)) + (turns[i + 2] - turns[k]) * math.log10(4)))
        for k, cost in spans:
            c = at + cost + SEGMENT
            if c < best[k]:
                best[k] = c
    return best[n]


def base_spans(text: str, low: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pattern kinds, leftmost and non-overlapping within a kind; ``low`` is the text in lower case."""
    out = []
    if any(h in low for h in ASSIGN_HINTS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    return out + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def own_words(text: str) -> Iterator[str]:
    """Whole words between white space, in lower case."""
    for w in text.split():
        if WORD.fullmatch(w := w.strip(EDGES)):
            yield w.lower()


def context_values(text: str) -> Iterator[tuple[int, int]]:
    """Places of the values of CONTEXT. A value may end with a context of its own (``pwd: token: ...``), whose value follows."""
    at = end = 0
    while m := CONTEXT.search(text, at):
        if m.end(1) > end:
            yield m.span(1)
            end = m.end(1)
            at = max(m.start(1), end - HEAD)
        else:  # a part of the value before
            at = m.start() + 1


def bearer_values(text: str) -> Iterator[tuple[int, int]]:
    """Places of the values that follow ``bearer`` without a separator; words of prose are none."""
    for m in BEARER.finditer(text):
        if not all(WORD.fullmatch(w) or len(w) < 4 and w.isalpha() for w in re.split(r"[\W_]+", m[1]) if w):
            yield m.span(1)


def guess_spans(text: str, low: str, words: Iterable[str] = COMMON, least: float = LEAST_LOG10) -> list[tuple[int, int, float]]:
    """(start, end, log10 guesses) of the credential-context values that need ``10 ** least`` guesses or more.

    The dictionary is ``words``, then the text's own words, which stand outside the values.
    """
    found = set()
    if any(h in low for h in CONTEXT_HINTS):
        found |= {*context_values(text), *bearer_values(text)}
    if "://" in text:
        found |= {m.span(1) for m in USER_PART.finditer(text)}
    if not found:
        return []
    at, rest = 0, []
    for s, e in sorted(found):
        rest.append(text[at : max(at, s)])
        at = max(at, e)
    rest.append(text[at:])
    ranks: dict[str, int] = {}
    for w in [*words, *own_words(" ".join(rest))]:
        ranks.setdefault(w, len(ranks) + 1)
    costs = ((s, e, guess_cost(text[s:e], ranks)) for s, e in sorted(found))
    return [x for x in costs if x[2] >= least]


def scan(text: str | None) -> list[tuple[str, int, int, float | None]]:
    """(kind, start, end, log10 guesses or None) by start, then kind; places in code points, end exclusive.

    The pattern spans all stay. A guessed span, the value alone, is added to them
    unless a pattern span has the same places.
    """
    if not text:
        return []
    low = text.lower()
    base = base_spans(text, low)
    more = [(s, e, "guess", g) for s, e, g in guess_spans(text, low) if (s, e) not in {x[:2] for x in base}]
    spans = [(*x, None) for x in base] + more
    return [(k, s, e, g) for s, e, k, g in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))]


def mask(text: str | None) -> str | None:
    """The text with every span replaced by ``<SECRET>``; overlapping spans are one."""
    spans = scan(text)
    if not spans:
        return text
    out, at = [], 0
    for _, s, e, _ in spans:
        if s >= at:
            out += [text[at:s], "<SECRET>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


SPAN_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("log10_guesses", T.DoubleType()),
        ]
    )
)


@F.pandas_udf(SPAN_TYPE)
def _spans(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in parts:
        yield pd.Series([[dict(zip(("kind", "start", "end", "log10_guesses"), x)) for x in scan(t)] for t in texts], dtype=object)


@F.pandas_udf(T.StringType())
def _masked(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in parts:
        yield pd.Series([mask(t) for t in texts], dtype=object)


def find_secrets(docs: DataFrame, out: str = "secrets", text: str = "text") -> DataFrame:
    """Add ``out``: the secrets of the whole text as an array of spans.

    A null or empty text has none. Rows are taken one by one: repeated rows get
    the same spans, an empty table stays empty, other columns stay as they are.
    """
    return docs.select("*", _spans(F.col(text)).alias(out))


def redact_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with every secret replaced by ``<SECRET>``; ``n_chars``, where there is one, follows the new text."""
    (new,) = private(docs, "masked")
    d = docs.select("*", _masked(F.col(text)).alias(new))
    columns = []
    for c in docs.columns:
        if c == text:
            columns.append(F.col(new).alias(c))
        elif c == "n_chars":
            changed = ~F.col(new).eqNullSafe(F.col(f"`{text}`"))
            columns.append(F.when(changed, F.length(new)).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col(f"`{c}`"))
    return d.select(*columns)


def span_text(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the spans of ``kinds``, comma-joined in their order."""
    some = F.filter(spans, lambda x: x["kind"].isin(*kinds))
    return F.array_join(F.transform(some, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _number(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")


def secret_digest(docs: DataFrame) -> DataFrame:
    """doc_id, the number of spans of each pattern kind, the SHA-256 of the pattern spans, and all spans as text.

    A row for each row of ``docs``, repeated ones and null ids included. Null and empty texts have no
    spans: zero counts, the digest of the empty text, and empty ``spans``. Other columns are left
    behind, whatever their names; an empty table gives an empty result.
    """
    (s,) = private(docs, "secrets")
    # a column of its own, so that each text is scanned once
    d = find_secrets(docs.select("doc_id", text_or_empty(F.col("text")).alias("text")), s)
    n = [_number(F.col(s), k).alias(f"n_{k}") for k in KINDS]
    return d.select(
        "doc_id",
        *n[: len(BASE_KINDS)],
        F.sha2(span_text(F.col(s), BASE_KINDS), 256).alias("base_sha256"),
        span_text(F.col(s)).alias("spans"),
        n[-1],
    )
