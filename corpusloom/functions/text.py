"""Scalar functions as Column expressions; all run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Unicode has it; Java's ``\s`` stops at ASCII.
WS = r"[\x09-\x0d\x1c-\x20\x85\p{Z}]+"
SENTENCE_MARK = "[。！？.!?]"
MATCHABLE = "[0-9A-Za-z가-힣]+"

# Romanised Hangul: initials, vowels and finals in code point order; "-" is silent.
INITIALS = "g gg n d dd r m b bb s ss - j jj ch k t p h".replace("-", "").split(" ")
VOWELS = "a ae ya yae eo e yeo ye o wa wae oe yo u wo we wi yu eu ui i".split(" ")
FINALS = "- g gg gs n nj nh d r rg rm rb rs rt rp rh m b bs s ss ng j ch k t p h".replace("-", "").split(" ")


def stable_round(x: Column, places: int) -> Column:
    """Rounding that the order of a sum's terms doesn't change; for values from 0 on."""
    return F.round(F.round(x, 9) + F.lit(1e-9), places)


def normalize_text(s: Column) -> Column:
    """White space collapsed and trimmed; null becomes empty."""
    return F.coalesce(F.trim(F.regexp_replace(s.cast("string"), WS, " ")), F.lit(""))


def romanize_hangul(s: Column) -> Column:
    """Each Hangul syllable as its romanised parts, every other character in lower case."""

    def part(names: list[str], index: Column) -> Column:
        return F.element_at(F.array(*map(F.lit, names)), index.cast("int") + 1)

    def one(c: Column) -> Column:
        at = F.ascii(c) - F.lit(0xAC00)
        vowel = F.floor((at % 588) / 28)
        roman = F.concat(part(INITIALS, F.floor(at / 588)), part(VOWELS, vowel), part(FINALS, at % 28))
        return F.when(at.between(0, 11171), roman).otherwise(F.lower(c))

    # most texts have no Hangul at all: ASCII needs no look at single characters
    return F.when(s.rlike("^[\\x00-\\x7f]*$"), F.lower(s)).otherwise(F.array_join(F.transform(F.split(s, ""), one), ""))


def _matchable(s: Column) -> Column:
    # picking the runs is several times faster in Java than replacing what a negated class of ranges matches
    return F.regexp_extract_all(F.coalesce(s.cast("string"), F.lit("")), F.lit(MATCHABLE), F.lit(0))


def match_text(s: Column) -> Column:
    """What alignment compares: letters a to z, digits and Hangul, romanised, single blanks between."""
    return romanize_hangul(F.lower(F.array_join(_matchable(s), " ")))


def match_tokens(s: Column) -> Column:
    return F.transform(_matchable(s), lambda w: romanize_hangul(F.lower(w)))


def token_overlap(hypothesis: Column, reference: Column) -> Column:
    """Share of the reference's different tokens that the hypothesis has; 0 if the reference has none."""
    ref = F.array_distinct(reference)
    return F.when(F.size(ref) > 0, F.size(F.array_intersect(hypothesis, ref)) / F.size(ref)).otherwise(F.lit(0.0))


def split_sentences(s: Column, words_a_chunk: int = 12) -> Column:
    """After sentence marks; without any mark, chunks of ``words_a_chunk`` words."""
    text = normalize_text(s)
    by_mark = F.filter(F.split(text, f"(?<={SENTENCE_MARK}) "), lambda x: x != "")
    words = F.split(text, " ")
    starts = F.sequence(F.lit(0), F.floor((F.size(words) - 1) / words_a_chunk).cast("int"))
    chunks = F.transform(starts, lambda k: F.array_join(F.slice(words, k * words_a_chunk + 1, words_a_chunk), " "))
    return F.when(text == "", F.array().cast("array<string>")).when(text.rlike(SENTENCE_MARK), by_mark).otherwise(chunks)


def length_scores(asr: Column, ref: Column, duration: Column) -> tuple[Column, Column, Column]:
    """The parts of the group score that need no text comparison: by words, by characters, by duration."""
    words = lambda t: F.greatest(F.lit(1), F.when(t == "", 0).otherwise(F.size(F.split(t, " "))))
    a, r = normalize_text(asr), normalize_text(ref)
    close = lambda x, y: F.lit(1.0) - F.least(F.abs(x - y) / y, F.lit(1.0))
    chars_a, chars_r = F.greatest(F.lit(1), F.length(match_text(a))), F.greatest(F.lit(1), F.length(match_text(r)))
    expected = chars_r / 7.0
    lasting = F.lit(1.0) - F.least(F.abs(F.greatest(F.lit(0.0), duration) - expected) / F.greatest(expected, F.lit(1.0)), F.lit(1.0))
    return close(words(a), words(r)), close(chars_a, chars_r), lasting


def first_path(doc: Column, paths: list[str]) -> tuple[Column, Column]:
    """The first non-empty value of the dotted paths of a JSON text, and its path; empty strings if there is none."""
    value, found = F.lit(""), F.lit("")
    for p in reversed(paths):
        v = normalize_text(F.get_json_object(doc, "$." + p))
        value, found = F.when(v != "", v).otherwise(value), F.when(v != "", F.lit(p)).otherwise(found)
    return value, found


def audio_path(label_path: Column, prefix: str, audio_dir: str) -> Column:
    """The first path part that starts with ``prefix`` becomes ``audio_dir``; the last suffix becomes .wav."""
    parts = F.split(label_path, "/")
    at = F.array_position(F.transform(parts, lambda p: p.startswith(prefix)), True)
    moved = F.array_join(F.transform(parts, lambda p, i: F.when(i + 1 == at, F.lit(audio_dir)).otherwise(p)), "/")
    return F.concat(F.regexp_replace(moved, r"(?<=[^/])\.[^./]*$", ""), F.lit(".wav"))


def category(name: Column) -> tuple[Column, Column]:
    """Code and name around the first dot; without one, the whole for both."""
    dot = F.instr(name, ".")
    code = F.when(dot > 0, F.trim(F.substring_index(name, ".", 1))).otherwise(name)
    rest = F.when(dot > 0, F.trim(F.substring(name, dot + 1, F.length(name)))).otherwise(name)
    return code, rest


def speaker_meta(doc: Column, stem: Column) -> dict[str, Column]:
    """speaker_code, sex, age, area and speaker_id of a label, with the parts of its file's stem where it lacks them."""
    parts = F.split(stem, "-")
    info = lambda k: normalize_text(F.get_json_object(doc, f"$.Patient_info.{k}"))
    part = lambda n: F.coalesce(F.try_element_at(parts, F.lit(n + 1)), F.lit(""))
    or_else = lambda v, other: F.when(v != "", v).otherwise(other)
    code = or_else(info("SpeakerName"), F.when(F.size(parts) > 4, part(4)).otherwise(stem))
    out = {"speaker_code": code, "sex": or_else(info("Sex"), part(7)), "age": or_else(info("Age"), part(8)), "area": or_else(info("Area"), part(9))}
    joined = F.array_join(F.filter(F.array(*out.values()), lambda v: v != ""), "-")
    return out | {"speaker_id": or_else(joined, code)}


def clock(seconds: Column) -> Column:
    """HH:MM:SS of whole seconds, from 0 on."""
    s = F.greatest(F.lit(0), F.floor(seconds)).cast("bigint")
    return F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor((s % 3600) / 60), s % 60)


def shard_path(index: Column, speaker: Column, dirs: int = 256) -> Column:
    return F.concat(
        F.lit("audio/"), F.format_string("%03d", index % dirs), F.lit("/"), F.format_string("%08d", index), F.lit("_"), F.replace(speaker, F.lit("/"), F.lit("_")), F.lit(".flac")
    )


def word_edits(reference: Column, hypothesis: Column) -> Column:
    """Word-level edit distance of two word arrays.

    Each different word of a pair gets a character of its own, then the built-in character distance does the
    rest; for up to a million different words a pair, beyond which it is an error.
    """
    # a one-element array names the pair's parts, so that they are worked out once and not for every word
    pair = F.struct(reference.alias("r"), hypothesis.alias("h"), F.array_distinct(F.concat(reference, hypothesis)).alias("all"))

    def text(words: Column, known: Column) -> Column:
        def one(w: Column) -> Column:
            at = F.array_position(known, w)
            # from U+10000 on, so that none is a surrogate or a byte order mark
            return F.decode(F.unhex(F.lpad(F.hex(at + 0x10000), 8, "0")), "UTF-32")

        return F.array_join(F.transform(words, one), "")

    return F.transform(F.array(pair), lambda p: F.levenshtein(text(p["r"], p["all"]), text(p["h"], p["all"])))[0]


def words_of(s: Column) -> Column:
    text = normalize_text(s)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, " "))


def get_any_case(doc: Column, *names: str) -> Column:
    """The value of the first key, in document order, that equals one of the names but for case; for objects of strings."""
    entries = F.map_entries(F.from_json(doc, "map<string,string>"))
    hit = F.filter(entries, lambda e: F.lower(e["key"]).isin([n.lower() for n in names]))
    return F.try_element_at(hit, F.lit(1))["value"]
