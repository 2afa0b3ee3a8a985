"""Functions that no built-in expression covers, as Arrow-batched UDFs over pure-Python cores."""

from __future__ import annotations

import json
import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from corpusloom.functions.text import FINALS, INITIALS, MATCHABLE, VOWELS
from corpusloom.schemas import table

PY_WS = re.compile(r"\s+")
SEVERITY_KEY = re.compile("severity|grade|level|중증", re.IGNORECASE)
FENCE = re.compile("`{3}(?:json)?\\s*(.*?)`{3}", re.S | re.I)

def squeeze(value) -> str:
    return "" if value is None else PY_WS.sub(" ", str(value)).strip()


def romanize(text: str) -> str:
    if text.isascii():
        return text.lower()
    out = []
    for c in text:
        at = ord(c) - 0xAC00
        if 0 <= at <= 11171:
            initial, rest = divmod(at, 588)
            vowel, final = divmod(rest, 28)
            out += (INITIALS[initial], VOWELS[vowel], FINALS[final])
        else:
            out.append(c.lower())
    return "".join(out)


def match_words(text: str) -> list[str]:
    return [w.lower() for w in re.findall(MATCHABLE, text or "")]


def asr_normal(text, without_blanks: bool = False) -> str:
    """NFC, lower case, without punctuation, symbols and control characters."""
    folded = unicodedata.normalize("NFC", squeeze(text)).lower()
    kept = squeeze("".join(c for c in folded if unicodedata.category(c)[0] not in "PSC"))
    return kept.replace(" ", "") if without_blanks else kept


class Comparable:
    """A text made ready for comparison once; the aligner compares each many times."""

    __slots__ = ("roman", "tokens", "plain_words", "letters", "_rare", "_seeds")

    def __init__(self, text: str):
        words = match_words(text)
        self.roman = romanize(" ".join(words))
        self.tokens = {romanize(w) for w in words}
        self.plain_words = len(text.split())
        self.letters = Counter(self.roman)
        self._rare = self._seeds = None

    def ratio_of(self, asr: Comparable) -> float:
        """``text_ratio`` of another text with this one as the reference, whose characters are counted once."""
        if self._rare is None:
            self._rare = frequent(self.letters, len(self.roman))
            self._seeds = blanked(self.roman, self._rare, "\x01")
        return similarity(asr.roman, self.roman, self._rare, self._seeds)


def frequent(letters: Counter, n: int) -> set[str]:
    """The characters of a reference of 200 characters and more that no match may start from: those of over 1 % of it."""
    return {c for c, k in letters.items() if k > n // 100 + 1} if n >= 200 else set()


def blanked(text: str, gone: set[str], mark: str) -> str:
    return text.translate({ord(c): mark for c in gone}) if gone else text


def similarity(asr: str, ref: str, gone: set[str], seeds: str) -> float:
    """Twice the characters in matching blocks over all characters.

    Matching blocks: the longest common substring without ``gone`` characters (of equal ones the first in ``asr``, then in
    ``ref``), grown to both sides by characters of any kind; then the same to its left and to its right. Substrings are looked up by
    ``str.find``, which is far quicker than going through character pairs in Python.
    """
    own, find, matched = blanked(asr, gone, "\x00"), seeds.find, 0
    starts = [i for i, c in enumerate(own) if c != "\x00"] if gone else range(len(asr))
    todo = [(0, len(asr), 0, len(ref))]
    while todo:
        a, a_end, b, b_end = todo.pop()
        size, at, there = 0, a, b
        for i in starts[bisect_left(starts, a) : bisect_left(starts, a_end)]:
            if i + size >= a_end:
                break
            if (j := find(own[i : i + size + 1], b, b_end)) >= 0:
                size += 1
                while i + size < a_end and (k := find(own[i : i + size + 1], j, b_end)) >= 0:
                    j, size = k, size + 1
                at, there = i, j
        while at > a and there > b and asr[at - 1] == ref[there - 1]:
            at, there, size = at - 1, there - 1, size + 1
        while at + size < a_end and there + size < b_end and asr[at + size] == ref[there + size]:
            size += 1
        if size:
            matched += size
            if a < at and b < there:
                todo.append((a, at, b, there))
            if at + size < a_end and there + size < b_end:
                todo.append((at + size, a_end, there + size, b_end))
    return 2.0 * matched / (len(asr) + len(ref)) if asr or ref else 1.0


def text_ratio(asr: str, ref: str) -> float:
    """Ratcliff-Obershelp similarity; not symmetric, and long texts lose their most frequent characters."""
    gone = frequent(Counter(ref), len(ref))
    return similarity(asr, ref, gone, blanked(ref, gone, "\x01"))


def sequence_score(asr: Comparable, ref: Comparable) -> float:
    if not asr.roman or not ref.roman:
        return 0.0
    common = len(asr.tokens & ref.tokens) / len(ref.tokens) if ref.tokens else 0.0
    return 0.8 * ref.ratio_of(asr) + 0.2 * common


def group_score(asr: Comparable, n_words: int, seconds: float, ref: Comparable, by_text=sequence_score) -> float:
    """A quarter by text, the rest by numbers of words and characters and by duration at 7 characters a second."""

    def close(x, y):
        return 1.0 - min(abs(x - y) / y, 1.0)

    chars = max(1, len(ref.roman))
    expected = chars / 7.0
    off = abs(max(0.0, seconds) - expected) / (expected if expected > 1.0 else 1.0)
    lasting = 1.0 - min(off, 1.0)
    by_words, by_chars = close(n_words or max(1, asr.plain_words), max(1, ref.plain_words)), close(max(1, len(asr.roman)), chars)
    return 0.25 * by_text(asr, ref) + 0.35 * by_words + 0.20 * by_chars + 0.20 * lasting


def text_bound(asr: Comparable, ref: Comparable) -> float:
    """What ``sequence_score`` can't exceed: no more can match than characters, of each kind, both texts have."""
    if not asr.roman or not ref.roman:
        return 0.0
    common = len(asr.tokens & ref.tokens) / len(ref.tokens) if ref.tokens else 0.0
    shared = sum(min(n, ref.letters.get(c, 0)) for c, n in asr.letters.items())
    return 0.8 * (2.0 * shared / (len(asr.roman) + len(ref.roman))) + 0.2 * common


def find_severity(node, path=""):
    """Depth first in document order: the first key that names a severity and has a value; ('', '') if none."""
    items = node.items() if isinstance(node, dict) else ((f"[{i}]", v) for i, v in enumerate(node)) if isinstance(node, list) else ()
    for key, value in items:
        full = key if not path else path + key if isinstance(node, list) else f"{path}.{key}"
        if isinstance(node, list) and not path:
            full = key
        if isinstance(node, dict) and SEVERITY_KEY.search(key) and squeeze(value):
            return squeeze(value), full
        hit = find_severity(value, full)
        if hit[0]:
            return hit
    return "", ""


def salvage_json(text: str | None):
    """'SKIP', the first object that decodes (fenced blocks first, rubbish after it allowed), or None."""
    text = (text or "").strip()
    if text.startswith("SKIP"):
        return "SKIP"
    decode = json.JSONDecoder().raw_decode
    for block in (*FENCE.findall(text), text):
        at = block.find("{")
        while at >= 0:
            try:
                found, _ = decode(block, at)
            except json.JSONDecodeError:
                found = None
            if isinstance(found, dict):
                return found
            at = block.find("{", at + 1)
    return None


def flat_text(value) -> str:
    """Objects as 'key: value' lines, lists as lines, empty ones left out."""
    if isinstance(value, dict):
        lines = [(k, flat_text(v)) for k, v in value.items()]
        return "\n".join(f"{k}: {v}" for k, v in lines if v).strip()
    if isinstance(value, list):
        lines = [flat_text(v) for v in value]
        return "\n".join(x for x in lines if x).strip()
    return "" if value is None else str(value).strip()


def any_case(data: dict, *names: str):
    wanted = {n.lower() for n in names}
    return next((v for k, v in data.items() if str(k).lower() in wanted), None)


SECTIONS = {
    "CC": ("cc", "chief_complaint", "주소증"),
    "PI": ("pi", "present_illness", "현병력"),
    "A&P": ("평가와 계획", "assessment_and_plan", "a&p", "평가 및 계획", "ap", "assessment_plan"),
}
PLACEHOLDERS = ("[환자의 자연스러운 호소 문장]", "[구조화된 문진표]")


def sections(data: dict) -> dict[str, str]:
    return {title: flat_text(any_case(data, *names)) for title, names in SECTIONS.items()}


def has_sections(text: str) -> bool:
    return text.startswith("CC:") and "\nPI:" in text and "\nA&P:" in text


def output_text(data: dict) -> str:
    """The three sections; from the record itself if it has all, else from its output field; else empty."""
    own = sections(data)
    if all(own.values()):
        return "\n".join(f"{k}: {v}" for k, v in own.items())
    given = any_case(data, "output")
    if isinstance(given, dict) and any((inner := sections(given)).values()):
        text = "\n".join(f"{k}: {v}" for k, v in inner.items() if v)
    else:
        text = flat_text(given)
    return text if has_sections(text) else ""


def is_valid_record(data) -> bool:
    if not isinstance(data, dict):
        return False
    keys = {str(k).lower() for k in data}
    if not {"instruction", "input"} <= keys or keys & {"qa_id", "status"}:
        return False
    for text in (flat_text(any_case(data, "instruction")), flat_text(any_case(data, "input")), output_text(data)):
        if len(text) < 5 or text.upper() in ("...", "SKIP") or any(p in text for p in PLACEHOLDERS):
            return False
    return True


#: Texts that are Python objects at a time.
AT_A_TIME = 64


def by_value(kind: T.DataType, name: str, one):
    """An Arrow UDF of ``one`` on single values.

    A batch of Arrow is limited in bytes, but its texts as Python objects and what is made of them take several times as many: a task
    holds those of a few rows at a time.
    """
    arrow = to_arrow_type(kind)

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for a in arrays:
            for k in range(0, len(a), AT_A_TIME):
                yield pa.array([one(v) for v in a.slice(k, AT_A_TIME).to_pylist()], arrow)

    run.__name__ = name
    return F.arrow_udf(kind)(run)


@F.pandas_udf(T.DoubleType())
def seq_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([sequence_score(Comparable(x or ""), Comparable(y or "")) for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def group_match_score(asr: pd.Series, words: pd.Series, seconds: pd.Series, ref: pd.Series) -> pd.Series:
    rows = zip(asr, words, seconds, ref)
    return pd.Series([group_score(Comparable(a or ""), int(w or 0), float(s or 0.0), Comparable(r or "")) for a, w, s, r in rows], dtype="float64")


def _severity(text):
    try:
        return find_severity(json.loads(text or "null"))
    except json.JSONDecodeError:
        return "", ""


def _salvage(text):
    found = salvage_json(text)
    if found == "SKIP":
        return "skip", None
    if found is None:
        return "json_parse_failed", None
    return "valid" if is_valid_record(found) else "validation_failed", json.dumps(found, ensure_ascii=False)


asr_normalize = by_value(T.StringType(), "asr_normalize", asr_normal)
asr_normalize_compact = by_value(T.StringType(), "asr_normalize_compact", lambda t: asr_normal(t, True))
severity_lookup = by_value(table("value string, path string"), "severity_lookup", _severity)
#: status: skip, json_parse_failed, validation_failed or valid; json: the object, where there is one.
json_salvage = by_value(table("status string, json string"), "json_salvage", _salvage)
#: The same for a column that is filtered by its status: a filter isn't moved below it, where it would run a second time.
json_salvage_once = by_value(table("status string, json string"), "json_salvage", _salvage).asNondeterministic()
flatten_json = by_value(T.StringType(), "flatten_json", lambda t: flat_text(json.loads(t)) if t else "")
section_output = by_value(T.StringType(), "section_output", lambda t: output_text(json.loads(t)) if t else "")


def register(spark: SparkSession) -> None:
    """The functions under SQL names."""
    for f in (asr_normalize, seq_ratio, group_match_score, severity_lookup, json_salvage, flatten_json, section_output):
        spark.udf.register(f.__name__, f)
