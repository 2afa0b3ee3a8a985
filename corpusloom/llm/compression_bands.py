"""Quality rules: zstandard ratios over whole documents and fixed chunks.

A document passes when its word rules hold and its compression ratio (compressed bytes over
bytes) lies inside the band for its length, and no more than ``max_bad_chunks`` of its fixed
chunks leave the chunk band. Too low a ratio means repetition, too high a ratio means noise.

Short texts compress less, so the limits fall with length. The lower ones are points between which the limit goes in a straight
line over the logarithm of the length. They lie 0.01 below the least ratio of good labelled texts of that length, of which
16,000 of four languages were measured (those that also teach the dictionaries; ``tests/llm`` holds them against others). Signs of
two bytes and more repeat their first bytes and compress to less, so where over 30 % of the bytes belong to such the
limit falls, down to ``multibyte_low`` where all do. Each upper limit lies between prose and random base64
or alphanumerics in words (0.85 in 256 bytes, 0.77 in 1 KiB, 0.74 in 4 KiB), and above random words of small
letters, which no prose in an alphabet exceeds. Texts under ``small_below`` bytes are cut into chunks of 256 bytes,
longer ones into chunks of 1 KiB; the last chunk reaches back, so that no byte goes unjudged. Under 256
bytes the whole is the only chunk. Noise within ``max_bad_chunks`` of the chunks can pass. Signs of three bytes and more
compress less than letters, so a limit rises with their share of the bytes, up to the ``wide`` one.

Defined cases: a null text has no words, fails the base rules and is rejected, as is an empty
one. Rows with equal ids or texts are judged one by one. An empty table gives an empty result.
Only the two named columns are read, so further columns of any name don't matter. The text is
used whole; memory is in proportion to the longest one.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass

import zstandard
from pyspark.sql import DataFrame

from corpusloom.llm.common import SPACE_CHARS, map_columns

SYMBOLS = b"#*$%&|<>"
#: First bytes of signs of three and four bytes.
WIDE_LEADS = bytes(range(0xE0, 0x100))
ASCII = bytes(range(0x80))


@dataclass(frozen=True)
class Bands:
    """``lows``: (bytes, least ratio), ascending. ``whole``: (bytes below which it holds, greatest ratio), ascending; the last has no upper end.

    ``wide``, ``wide_chunk``, ``wide_small_chunk``: the greatest ratios where every sign has three bytes or more.
    """

    min_words: int = 50
    max_repeat_percent: int = 50
    level: int = 3
    lows: tuple[tuple[int, float], ...] = ((256, 0.51), (640, 0.50), (1024, 0.472), (2048, 0.447), (4096, 0.430), (8192, 0.412), (16384, 0.402), (32768, 0.392), (65536, 0.383), (262144, 0.36))
    multibyte_low: float = 0.2
    whole: tuple[tuple[float, float], ...] = ((256, 0.82), (400, 0.79), (640, 0.75), (1024, 0.71), (4096, 0.66), (16384, 0.62), (float("inf"), 0.60))
    wide: tuple[float, ...] = (1.0, 0.95, 0.95, 0.95, 0.74, 0.72, 0.72)
    chunk_bytes: int = 1024
    chunk: tuple[float, float] = (0.485, 0.70)
    wide_chunk: float = 0.80
    small_below: int = 4096
    small_chunk_bytes: int = 256
    small_chunk: tuple[float, float] = (0.56, 0.85)
    wide_small_chunk: float = 0.98
    max_bad_chunks: float = 0.2


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a text."""
    if not text:
        return 0, 0, 0, 0, 0
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    chars = len(text) - sum(map(text.count, SPACE_CHARS))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    dup_lines = 0
    if "\n" in text:
        lines = [x for x in data.split(b"\n") if x.strip()]
        dup_lines = len(lines) - len(set(lines))
    repeated = 0
    if n > 3:
        seen = Counter(windows := list(zip(words, words[1:], words[2:])))
        if len(seen) < n - 2:
            end = 0
            for i, w in enumerate(windows):
                if seen[w] > 1:
                    repeated += i + 3 - max(i, end)
                    end = i + 3
    return n, chars, symbols, dup_lines, repeated


def raised(data: bytes, high: float, wide: float) -> float:
    """The upper limit for these bytes: between ``high`` and ``wide``, by the share of signs of three bytes or more."""
    if data.isascii():
        return high
    share = min(1.0, 3 * (len(data) - len(data.translate(None, WIDE_LEADS))) / len(data))
    return high + share * (wide - high)


def lowered(data: bytes, low: float, multibyte: float) -> float:
    """The lower limit for these bytes: between ``low`` and ``multibyte``, by how far signs of two bytes or more exceed 30 % of them."""
    if data.isascii():
        return low
    share = (len(data.translate(None, ASCII)) / len(data) - 0.3) / 0.7
    return low + max(0.0, share) * min(0.0, multibyte - low)


def least_ratio(n: int, lows: tuple[tuple[int, float], ...]) -> float:
    """The lower limit for ``n`` bytes, in a straight line over log(n) between the points, level beyond the outer ones."""
    k = bisect_right(lows, n, key=lambda p: p[0])
    if not 0 < k < len(lows):
        return lows[max(0, k - 1)][1]
    (a, x), (b, y) = lows[k - 1], lows[k]
    return x + (y - x) * math.log(n / a) / math.log(b / a)


def judge(text: str | None, rules: Bands, squeeze) -> tuple:
    """The base counts, then base_failed, kept, the whole ratio and the share of chunks out of band."""
    counts = base_counts(text)
    n_words, repeated = counts[0], counts[4]
    failed = n_words < rules.min_words or 100 * repeated > rules.max_repeat_percent * n_words
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return (*counts, failed, False, None, None)
    ratio = len(squeeze(data)) / len(data)
    high, wide = next((h, w) for (top, h), w in zip(rules.whole, rules.wide) if len(data) < top)
    small = len(data) < rules.small_below
    size = rules.small_chunk_bytes if small else rules.chunk_bytes
    low_c, high_c, wide_c = (*rules.small_chunk, rules.wide_small_chunk) if small else (*rules.chunk, rules.wide_chunk)
    starts = [min(i, len(data) - size) for i in range(0, len(data), size)] if len(data) >= size else []
    chunks = [data[i : i + size] for i in starts]
    bad = sum(not lowered(c, low_c, rules.multibyte_low) <= len(squeeze(c)) / size <= raised(c, high_c, wide_c) for c in chunks) / len(chunks) if chunks else 0.0
    inside = lowered(data, least_ratio(len(data), rules.lows), rules.multibyte_low) <= ratio <= raised(data, high, wide)
    return (*counts, failed, not failed and inside and bad <= rules.max_bad_chunks, ratio, bad)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio", "bad_chunks")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Bands = Bands()) -> DataFrame:
    """One row per document: id, base counts, ``base_failed``, ``kept``, ``ratio``, ``bad_chunks``. A scan, no shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()

    def batch(ids, texts):
        squeeze = zstandard.ZstdCompressor(level=rules.level).compress
        rows = [judge(t, rules, squeeze) for t in texts]
        return {"id": ids} | {n: [r[k] for r in rows] for k, n in enumerate(NAMES)}

    out = map_columns(
        docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text"),
        ("id", "text"),
        f"id {kind}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
        "base_failed boolean, kept boolean, ratio double, bad_chunks double",
        batch,
    )
    return out.withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, text_col: str = "text", rules: Bands = Bands()) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text the rules keep. One scan, no join back by id.

    Every column passes through as Arrow, so nulls, repeated rows and clashing names stay as they are.
    """
    kinds, at = docs.schema, docs.columns.index(text_col)

    def run(batches):
        import pyarrow as pa

        squeeze = zstandard.ZstdCompressor(level=rules.level).compress
        for b in batches:
            yield b.filter(pa.array([judge(t, rules, squeeze)[6] for t in b.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, kinds)
