"""Personal data by anchor expansion.

An Aho-Corasick automaton finds at-signs, plus-signs, digits, URL schemes and identifier cues in
one pass over a text; at each anchor a deterministic parser expands to the left and right and
validates what it found. No regular expression runs over the text.

Kinds, in the order in which they are listed: email, ip, card, phone (their grammar is that of
``parse_*`` below: leftmost, non-overlapping in each kind, failing matches dropped), then what the
cues add: iban (mod-97 checked), ssn (both within ``REACH`` code points after a cue, whatever stands between),
url_login (``scheme://user:secret@host``) and secret (cloud keys, and the value after ``password=``, ``token =``
and like cues). Cues are matched in any case. Account and passport numbers that have no check are no kind.

Defined cases: a null text counts as empty and has no span. Spans of different kinds may overlap.
Offsets are code points, the end exclusive. Equal rows give equal results, one per row; an empty
table gives an empty result. Texts are searched whole, in time linear in their length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import lru_cache
from heapq import merge

import ahocorasick
from pyspark.sql import DataFrame

from corpusloom.llm.common import map_columns

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "url_login", "secret")
BASE = KINDS[:4]
RANK = {k: i for i, k in enumerate(KINDS)}

DIGITS = frozenset("0123456789")
LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
LOCAL = LETTERS | DIGITS | frozenset("._%+-")
LABEL = LETTERS | DIGITS | frozenset("-")
PHONE = DIGITS | frozenset(" ().-")
WORD = LETTERS | DIGITS | frozenset("_")
VALUE = LETTERS | DIGITS | frozenset("_-+/=.~!$")
QUOTES = frozenset("\"' ")
LOGIN = LOCAL | frozenset(":")
HOST = LABEL | frozenset(".")
KEY = WORD | frozenset("-")

SECRET_CUES = ("password", "passwd", "secret", "token", "api_key", "apikey", "access_key")
KEY_PREFIXES = {"AKIA": 16, "ASIA": 16, "ghp_": 36, "gho_": 36, "glpat-": 20}
SSN_CUES = ("ssn", "social security", "social-security")
IBAN_CUES = ("iban", "account")
#: Code points after a cue, or after a number found there, within which a number begins.
REACH = 40

CAPITALS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ")

Span = tuple[int, int]


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """Anchors whose case counts: '@', '+', each digit, '://' and key prefixes, with what they are for."""
    a = ahocorasick.Automaton()
    for c in "@+":
        a.add_word(c, c)
    for c in DIGITS:
        a.add_word(c, "d")
    a.add_word("://", ":")
    for prefix in KEY_PREFIXES:
        a.add_word(prefix, "k" + prefix)
    a.make_automaton()
    return a


@lru_cache(maxsize=1)
def cue_automaton() -> ahocorasick.Automaton:
    """Cues in small letters, with what they are for."""
    a = ahocorasick.Automaton()
    for cues, what in ((SECRET_CUES, "s"), (SSN_CUES, "n"), (IBAN_CUES, "b")):
        for cue in cues:
            a.add_word(cue, what)
    a.make_automaton()
    return a


def small_letters(text: str) -> str:
    """The text in small letters, each at its old place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def run_right(text: str, i: int, allowed: frozenset, most: int = 1 << 62) -> int:
    """The end of the run of allowed characters from ``i`` on, ``i + most`` at most."""
    n = min(len(text), i + most)
    while i < n and text[i] in allowed:
        i += 1
    return i


def parse_email(text: str, at: int, floor: int) -> Span | None:
    """local@label(.label)+ around the at-sign, starting no earlier than ``floor``."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    if start == at:
        return None
    end = run_right(text, at + 1, LABEL)
    if end == at + 1:
        return None
    labels = 1
    while end < len(text) and text[end] == ".":
        nxt = run_right(text, end + 1, LABEL)
        if nxt == end + 1:
            break
        end, labels = nxt, labels + 1
    return (start, end) if labels > 1 else None


def digit_runs(text: str, i: int, joint: str) -> list[Span]:
    """Runs of digits from ``i`` on, each joined to the next by exactly one character of ``joint``."""
    runs = []
    while True:
        end = run_right(text, i, DIGITS)
        if end == i:
            return runs
        runs.append((i, end))
        if end >= len(text) or text[end] not in joint:
            return runs
        i = end + 1


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        total += v if k % 2 == 0 else (2 * v - 9 if v > 4 else 2 * v)
    return total % 10 == 0


def parse_phone(text: str, plus: int) -> Span | None:
    """'+', a digit, one or more of digits, blanks, dots, hyphens and brackets, a digit."""
    if plus + 1 >= len(text) or text[plus + 1] not in DIGITS:
        return None
    end = run_right(text, plus + 2, PHONE)
    while end > plus + 2 and text[end - 1] not in DIGITS:
        end -= 1
    return (plus, end) if end - plus >= 4 else None


class ValueRuns:
    """Ends of the runs of value characters. The run scanned last is remembered, so cues inside one don't scan it again."""

    def __init__(self, text: str):
        self.text, self.start, self.end, self.stop, self.digit = text, 0, 0, 0, -1

    def at(self, i: int) -> tuple[int, bool]:
        """Where the run from ``i`` on ends, less closing dots and exclamation marks, and whether it has a digit."""
        if not self.start <= i < self.end:
            self.start, self.end = i, run_right(self.text, i, VALUE)
            run = self.text[i : self.end]
            self.stop = i + len(run.rstrip(".!"))
            self.digit = i + max(map(run.rfind, "0123456789"))
        return max(i, self.stop), i <= self.digit < self.stop


def parse_secret(text: str, end: int, runs: ValueRuns) -> Span | None:
    """The value after a cue that ends at ``end``: blanks, '=' or ':', blanks, quotes; 8 or more characters with a digit."""
    i = run_right(text, end, QUOTES)
    if i >= len(text) or text[i] not in "=:":
        return None
    i = run_right(text, i + 1, QUOTES)
    stop, digit = runs.at(i)
    return (i, stop) if stop - i >= 8 and digit else None


def iban_end(text: str, k: int) -> int:
    """The end of two capitals, two digits and 11 to 30 capitals or digits more, each after one blank at most; ``k`` if there is none."""
    if not (text[k] in CAPITALS and text[k + 1 : k + 2] in CAPITALS and text[k + 2 : k + 3] in DIGITS and text[k + 3 : k + 4] in DIGITS):
        return k
    end, n = k + 4, 0
    while n < 30:
        nxt = end + (text[end : end + 1] == " ")
        if text[nxt : nxt + 1] not in CAPITALS and text[nxt : nxt + 1] not in DIGITS:
            break
        end, n = nxt + 1, n + 1
    return end if n >= 11 else k


def parse_iban(text: str, i: int) -> Span | None:
    """The first IBAN that starts within ``REACH`` characters of ``i``: letters, check digits, 11 to 30 more, mod 97 is 1."""
    for k in range(i, min(i + REACH + 1, len(text))):
        if text[k] in CAPITALS and (k == i or text[k - 1] not in WORD):
            end = iban_end(text, k)
            while len(flat := text[k:end].replace(" ", "")) >= 15:
                if text[end - 1] != " " and int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1:
                    return k, end
                end -= 1
    return None


def parse_ssn(text: str, i: int) -> Span | None:
    """The first number like 123-45-6789 that starts within ``REACH`` characters of ``i``."""
    for k in range(i, min(i + REACH + 1, len(text) - 10)):
        if text[k + 3] == text[k + 6] == "-" and (k == i or text[k - 1] not in WORD):
            digits = text[k : k + 11].replace("-", "")
            if len(digits) == 9 and digits.isdecimal() and (k + 11 == len(text) or text[k + 11] not in WORD):
                return k, k + 11
    return None


def parse_login(text: str, colon: int) -> Span | None:
    """``scheme://user:secret@host`` around the ':' of '://'."""
    start = colon
    while start > 0 and text[start - 1] in LETTERS:
        start -= 1
    host = run_right(text, colon + 3, LOGIN)
    if start == colon or host >= len(text) or text[host] != "@" or ":" not in text[colon + 3 : host]:
        return None
    end = run_right(text, host + 1, HOST)
    return (start, end) if end > host + 1 else None


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of a text as (kind, start, end), ordered by start, then kind as listed, then end."""
    if not text:
        return []
    found: list[tuple[int, int, int, str]] = []
    add = lambda kind, span: found.append((span[0], RANK[kind], span[1], kind))
    listed: set[tuple[str, Span]] = set()
    values = ValueRuns(text)
    after_email = after_ip = after_card = after_phone = after_secret = 0
    for at, what in merge(automaton().iter(text), cue_automaton().iter(small_letters(text)), key=lambda x: x[0]):
        first = what[0]
        if first == "d":
            if at >= after_card:
                runs = digit_runs(text, at, " -")
                after_card = runs[-1][1]
                n = sum(b - a for a, b in runs)
                if 14 <= n <= 19 and luhn("".join(text[a:b] for a, b in runs)):
                    add("card", (at, after_card))
            if at >= after_ip:
                runs = digit_runs(text, at, ".")
                after_ip = runs[-1][1]
                for k in range(0, len(runs) - 3, 4):
                    if all(b - a < 4 or not text[a : b - 3].strip("0") for a, b in runs[k : k + 4]) and all(int(text[max(a, b - 3) : b]) < 256 for a, b in runs[k : k + 4]):
                        add("ip", (runs[k][0], runs[k + 3][1]))
        elif first == "@":
            if span := parse_email(text, at, after_email):
                after_email = span[1]
                add("email", span)
        elif first == "+":
            if at >= after_phone and (span := parse_phone(text, at)):
                after_phone = span[1]
                if 10 <= sum(c in DIGITS for c in text[span[0] : span[1]]) <= 15:
                    add("phone", span)
        elif first == "k":
            start, size = at + 1 - len(what) + 1, KEY_PREFIXES[what[1:]]
            end = run_right(text, at + 1, KEY, size + 1)
            if (start == 0 or text[start - 1] not in WORD) and end - at - 1 == size and start >= after_secret:
                after_secret = end
                add("secret", (start, end))
        elif first == "s":
            if (span := parse_secret(text, at + 1, values)) and span[0] >= after_secret:
                after_secret = span[1]
                add("secret", span)
        else:
            parse, kind = {"b": (parse_iban, "iban"), "n": (parse_ssn, "ssn"), ":": (parse_login, "url_login")}[first]
            span = parse(text, at - 2 if first == ":" else at + 1)
            if span and first != ":" and (kind, span) in listed:
                continue  # an earlier cue has listed it and what follows
            while span:
                add(kind, span)
                listed.add((kind, span))
                span = parse(text, span[1]) if first != ":" else None
    return [(kind, a, b) for a, _, b, kind in sorted(set(found))]


def redact_text(text: str | None, mask: Callable[[str], str] = lambda kind: f"<{kind.upper()}>") -> str | None:
    """The text with every span replaced by its kind's mark; overlapping spans become one, marked by the first."""
    return masked(text, find_spans(text), mask)


def masked(text: str | None, spans: list[tuple[str, int, int]], mask: Callable[[str], str] = lambda kind: f"<{kind.upper()}>") -> str | None:
    if not spans:
        return text
    parts, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            parts += [text[at:a], mask(kind)]
        at = max(at, b)
    return "".join([*parts, text[at:]])


def show(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per document: id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans and, if ``with_text``, the masked text. A scan, no shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()

    def batch(ids, texts):
        found = [find_spans(t) for t in texts]
        base = [[s for s in x if s[0] in BASE] for x in found]
        out = {"id": ids, "spans": [show(x) for x in found]}
        out["n_spans"] = [len(x) for x in found]
        if with_text:
            out["text"] = [masked(t, x) for t, x in zip(texts, found)]
        out["base_sha256"] = [hashlib.sha256(show(x).encode()).hexdigest() for x in base]
        return out | {f"n_{k}": [sum(s[0] == k for s in x) for x in base] for k in BASE}

    out = map_columns(
        docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text"),
        ("id", "text"),
        f"id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_spans bigint" + ", text string" * with_text,
        batch,
    )
    return out.withColumnRenamed("id", id_col)


def redact(docs: DataFrame, text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with the spans of its texts masked; ``size_col``, where present, becomes the new length. Other columns stay."""
    import pyarrow as pa

    kinds, at = docs.schema, docs.columns.index(text_col)
    size_at = docs.columns.index(size_col) if size_col in docs.columns else -1

    def run(batches):
        for b in batches:
            cols = list(b.columns)
            texts = [redact_text(t) for t in b.column(at).to_pylist()]
            cols[at] = pa.array(texts, b.schema.field(at).type)
            if size_at >= 0:
                cols[size_at] = pa.array([None if t is None else len(t) for t in texts], b.schema.field(size_at).type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return docs.mapInArrow(run, kinds)
