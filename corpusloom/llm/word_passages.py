"""Passages of at least ``width`` words in a row that several documents have, exactly and over a whole corpus.

Words are what ``bytes.split()`` gives, so that line breaks between them don't matter and short words count as long ones do. Every window of
``width`` words has a key, the least hash of the ``GRAM``-word strings in it, and windows in a row with one key make a fragment:

1. A scan turns texts into fragment records (key, hash of the windows, row, place), some 1 per 20 words.
2. Records whose key only one row has can't be shared: dropped. Fragments that agree in all windows and lie in several rows are shared as a whole.
3. Of the others, and one copy of each of those, the hashes of all windows go to their key's partition, where windows of several rows are found.
4. Key groups of over ``hot`` windows don't go to one task: their windows are counted one by one, in a shuffle.

Windows are equal if key and hash, of 64 bits each, are. A row is told from others by its name (a, b); rows that share a name, being equal in id
and text, share all they have. What repeats in one document only is not shared.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import SPACE_CHARS, cut, map_batches
from corpusloom.llm.minhash import BASE, mix, rolling, sliding_min

#: Over 50 words.
WIDTH = 51
GRAM = 12
HOT_WINDOWS = 2_000_000
#: Windows that are compared at a time, and bytes hashed at a time.
BLOCK, SLICE = 1_000_000, 1 << 16
#: The end of a span that reaches to the end of its text.
OPEN_END = 0x7FFFFFFF
BYTES = mix(np.arange(1, 257, dtype=np.uint64))
SPACE = np.isin(np.arange(256), list(SPACE_CHARS.encode()))
GAP = re.compile(f"[{SPACE_CHARS}]".encode())
STEP = np.uint64(0x9E3779B97F4A7C15)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.cumprod(out)


TABLES = [_powers(x, 2 * SLICE) for x in (int(BASE), pow(int(BASE), -1, 1 << 64))]


def _hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of ``data``, which begins and ends with a space."""
    x = np.frombuffer(data, np.uint8)
    gap = SPACE[x]
    edges = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    up, down = TABLES if len(x) <= 2 * SLICE else [_powers(int(t[1]), len(x)) for t in TABLES]
    upto = np.cumsum(BYTES[x] * up[: len(x)])
    return starts, mix((upto[ends - 1] - upto[starts - 1]) * down[starts])


def _pieces(text: bytes):
    """A long text in pieces that end between words."""
    at = 0
    while len(text) - at > SLICE and (gap := GAP.search(text, at + SLICE)):
        yield text[at : gap.start()]
        at = gap.end()
    yield text[at:] if at else text


def parts(texts: list[bytes]):
    """Yield (number of the first text, hashes of all words, words of each text) for some texts in a row, or a long one, at a time."""
    part, size, first = [], 0, 0
    for k in range(len(texts) + 1):
        if part and (k == len(texts) or size + len(texts[k]) > SLICE):
            if len(part) == 1:
                codes = np.concatenate([_hash_words(b" " + p + b" ")[1] for p in _pieces(part[0])])
                yield first, codes, np.array([len(codes)])
            else:
                starts, codes = _hash_words(b" " + b" ".join(part) + b" ")
                begin = np.cumsum([1, *(len(t) + 1 for t in part)])
                yield first, codes, np.diff(np.searchsorted(starts, begin))
            part, size, first = [], 0, k
        if k < len(texts):
            part.append(texts[k])
            size += len(texts[k])


def fragments(codes: np.ndarray, counts: np.ndarray, width: int, gram: int):
    """Yield arrays (text, first word, number of windows, key, hash of the windows) of the fragments of texts with so many words each."""
    if len(codes) < width:
        return
    if len(counts) == 1 and len(codes) > 2 * SLICE:
        # as in ``substring_dedup``: slices overlap by all but one word of a window
        for a in range(0, len(codes) - width + 1, SLICE):
            some = codes[a : a + SLICE + width - 1]
            for text, at, *rest in fragments(some, np.array([len(some)]), width, gram):
                yield text, at + a, *rest
        return
    low, whole = sliding_min(mix(rolling(codes, gram)), width - gram + 1), mix(rolling(codes, width))
    owner = np.repeat(np.arange(len(counts)), counts)
    inside = owner[: len(low)] == owner[width - 1 :]
    new = inside.copy()
    new[1:] &= (low[1:] != low[:-1]) | (owner[1 : len(low)] != owner[: len(low) - 1])
    begin = np.flatnonzero(new)
    if not len(begin):
        return
    which = np.cumsum(new) - 1
    n = np.bincount(which[inside], minlength=len(begin))
    place = (np.arange(len(low)) - begin[np.maximum(which, 0)]).astype(np.uint64)
    hashes = np.add.reduceat(np.where(inside, mix(whole + place * STEP), np.uint64(0)), begin)
    starts = np.cumsum(counts) - counts
    yield owner[begin], begin - starts[owner[begin]], n, low[begin].view(np.int64), hashes.view(np.int64)


def _records(rows: DataFrame, width: int, gram: int) -> DataFrame:
    def run(batches):
        for a, b, texts in batches:
            a, b = np.array(a, np.int64), np.array(b, np.int64)
            for first, codes, counts in parts([t.encode("utf-8", "surrogatepass") for t in texts]):
                for text, at, n, key, fh in fragments(codes, counts, width, gram):
                    yield {"m": key, "fh": fh, "a": a[first + text], "b": b[first + text], "at": at, "n": n}

    return map_batches(rows.where(F.octet_length("text") >= 2 * width - 1), ("a", "b", "text"), "m bigint, fh bigint, a bigint, b bigint, at int, n int", run)


def _fetch(rows: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """The hashes of all windows of the wanted fragments (m, a, b, at, n, whole), 8 bytes each."""
    lists = wanted.groupBy("a", "b").agg(F.collect_set(F.struct("m", "at", "n", "whole")).alias("x"))
    # as in ``substring_dedup``: with the id, so that all joins use one exchange of the rows
    joined = rows.join(lists, ["a", "b"]).dropDuplicates(["a", "b"]).select("id", "text", "a", "b", "x.m", "x.at", "x.n", "x.whole", F.xxhash64("a", "b").alias("r"))

    def run(batches):
        for _, texts, a, b, m, at, n, shared, r in batches:
            for first, codes, counts in parts([t.encode("utf-8", "surrogatepass") for t in texts]):
                out, hashes = {c: [] for c in ("m", "r", "a", "b", "at", "whole", "data")}, mix(rolling(codes, width))
                for k, s in enumerate((np.cumsum(counts) - counts).tolist(), first):
                    for c, v in zip(out, (m[k], [r[k]] * len(m[k]), [a[k]] * len(m[k]), [b[k]] * len(m[k]), at[k], shared[k])):
                        out[c] += v
                    out["data"] += [hashes[s + i : s + i + z].tobytes() for i, z in zip(at[k], n[k])]
                yield out

    return map_batches(joined, ("id", "text", "a", "b", "m", "at", "n", "whole", "r"), "m bigint, r bigint, a bigint, b bigint, at int, whole boolean, data binary", run)


def shared_windows(key: np.ndarray, row: np.ndarray, whole: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each window is one that windows of other rows equal, or one of a fragment that is shared as a whole."""
    order = np.lexsort((hashes, key))
    k, h = key[order], hashes[order]
    begin = np.flatnonzero(np.append(True, (k[1:] != k[:-1]) | (h[1:] != h[:-1])))
    r = row[order]
    found = (np.minimum.reduceat(r, begin) != np.maximum.reduceat(r, begin)) | np.logical_or.reduceat(whole[order], begin)
    out = np.empty(len(key), bool)
    out[order] = np.repeat(found, np.diff(np.append(begin, len(key))))
    return out


def _compared(found: DataFrame, width: int) -> DataFrame:
    """Spans (a, b, s, e) of the windows that several rows have, a block of whole key groups at a time."""

    def spans(block):
        m, r, a, b, at, whole, data = zip(*block)
        n = np.array([len(x) // 8 for x in data])
        wide = lambda x, kind: np.repeat(np.array(x, kind), n)
        yes = shared_windows(wide(m, np.int64), wide(r, np.int64), wide(whole, bool), np.frombuffer(b"".join(data), np.uint64)) & ~wide(whole, bool)
        of = np.repeat(np.arange(len(n)), n)
        edge = of[1:] != of[:-1]
        first = yes & np.append(True, edge | ~yes[:-1])
        last = yes & np.append(edge | ~yes[1:], True)
        first, last = np.flatnonzero(first), np.flatnonzero(last)
        which, place = of[first], np.array(at, np.int64) - (np.cumsum(n) - n)
        return {"a": np.array(a, np.int64)[which], "b": np.array(b, np.int64)[which], "s": place[which] + first, "e": place[which] + last + width}

    def run(batches):
        block, size, key = [], 0, None
        for lists in batches:
            for row in zip(*lists):
                if row[0] != key and size > BLOCK:
                    yield spans(block)
                    block, size = [], 0
                key = row[0]
                block.append(row)
                size += len(row[-1]) // 8
        if block:
            yield spans(block)

    return map_batches(found.repartition("m").sortWithinPartitions("m"), ("m", "r", "a", "b", "at", "whole", "data"), "a bigint, b bigint, s int, e int", run)


def _counted(found: DataFrame, width: int) -> DataFrame:
    """As ``_compared``, with a row per window; for key groups of any size."""

    def run(batches):
        for m, r, a, b, at, whole, data in batches:
            for k in range(len(m)):
                h = np.frombuffer(data[k], np.int64)
                yield {"m": [m[k]] * len(h), "h": h, "r": [r[k]] * len(h), "a": [a[k]] * len(h), "b": [b[k]] * len(h), "s": at[k] + np.arange(len(h)), "whole": [whole[k]] * len(h)}

    windows = cut(map_batches(found, ("m", "r", "a", "b", "at", "whole", "data"), "m bigint, h bigint, r bigint, a bigint, b bigint, s int, whole boolean", run))
    several = windows.groupBy("m", "h").agg(F.min("r").alias("lo"), F.max("r").alias("hi"), F.max("whole").alias("some")).where("lo < hi OR some").select("m", "h")
    return windows.where("NOT whole").join(several, ["m", "h"], "left_semi").select("a", "b", "s", (F.col("s") + width).alias("e"))


def passage_spans(rows: DataFrame, width: int = WIDTH, gram: int = GRAM, hot: int = HOT_WINDOWS) -> DataFrame:
    """Spans of words (a, b, s, e), which may overlap, of rows (id, text, a, b): of what other rows have as well."""
    if not 0 < gram <= width:
        raise ValueError("gram must be within 1..width")
    records = cut(_records(rows, width, gram)).withColumn("r", F.xxhash64("a", "b"))
    ends = (F.min("r").alias("lo"), F.max("r").alias("hi"))
    live = cut(records.join(records.groupBy("m").agg(*ends).where("lo < hi").select("m"), "m", "left_semi"))
    content = live.groupBy("m", "fh").agg(*ends, F.min(F.struct("a", "b", "at", "n")).alias("x"))
    copied = cut(content.where("lo < hi").select("m", "fh", "x.*"))
    single = live.join(copied.select("m", "fh"), ["m", "fh"], "left_anti")
    both = single.select("m", "a", "b", "at", "n", F.lit(False).alias("whole")).unionByName(copied.select("m", "a", "b", "at", "n", F.lit(True).alias("whole")))
    groups = both.groupBy("m").agg(F.min(F.xxhash64("a", "b")).alias("lo"), F.max(F.xxhash64("a", "b")).alias("hi"), F.max("whole").alias("some"), F.min("whole").alias("all"), F.sum("n").alias("n"))
    groups = groups.where("NOT all AND (some OR lo < hi)").select("m", (F.col("n") > hot).alias("hot"))
    wanted = cut(both.join(groups, "m"))
    spans = live.join(copied.select("m", "fh"), ["m", "fh"], "left_semi").select("a", "b", F.col("at").alias("s"), (F.col("at") + F.col("n") + (width - 1)).alias("e"))
    spans = spans.unionByName(_compared(_fetch(rows, wanted.where("NOT hot").drop("hot"), width), width))
    if not wanted.where("hot").isEmpty():
        spans = spans.unionByName(_counted(_fetch(rows, wanted.where("hot").drop("hot"), width), width))
    twins = rows.where(F.octet_length("text") >= 2 * width - 1).groupBy("a", "b").count().where("count > 1")
    return spans.unionByName(twins.select("a", "b", F.lit(0).alias("s"), F.lit(OPEN_END).alias("e")))
