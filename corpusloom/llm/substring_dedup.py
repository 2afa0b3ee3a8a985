"""Exact removal of repeated substrings, over a whole corpus.

Every ``least``-byte string (window) of a text has a key: the least hash of the ``GRAM``-byte strings in
it. It depends on the window alone, so equal windows have equal keys, wherever they are. Windows in a row
with one key make a fragment. The steps:

1. A scan turns texts into fragment records (key, content hash, row, place), some 1 per 160 bytes.
2. Records whose key occurs once, in a fragment without inner repetition, can't repeat anything: dropped.
3. Records of equal content are counted together; content that occurs twice is repeated as a whole.
4. For keys with several different contents, one copy of each content is fetched from its text and sent
   to its key's partition. There a run-length index (``run_index``) of a block of whole key groups gives
   matching statistics, which mark what is repeated. Only this step moves text, and only of such fragments.
5. Key groups of over ``hot_bytes`` don't go to one task: their fragments are cut anew by the next longer
   gram of ``GRAMS``, and what lands in a group of its own, or in one small enough, goes through steps 2 to 4
   again. The last gram is the window itself, where a group is one content and counting it is enough.
6. Marks are gathered by row and joined to the texts once more.

No cap on copies, partners or lengths: every repeated window is found. Results don't depend on where
blocks begin, as equal windows always meet.

Defined cases: a null text counts as empty: 0 bytes, nothing removed. Texts under ``least`` bytes keep
all. Rows with equal ids and texts are documents of their own and repeat each other. Offsets are UTF-8
bytes, so a removed span may cut a character; what is kept is bytes. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import cut, map_batches, text_or_empty
from corpusloom.llm.minhash import mix, rolling, sliding_min
from corpusloom.llm.run_index import MAX_BYTES, RunIndex
from corpusloom.llm.word_passages import OPEN_END, passage_spans

LEAST = 400
#: Bytes of the grams whose least hash is a window's key; the first for all texts, the others for key groups that grew too large.
GRAMS = (72, 136, 208, 280, 344)
HOT_BYTES = 1_000_000
#: Bytes hashed at a time: the arrays, of eight bytes for each, should stay in a core's cache.
SLICE = 1 << 16
BYTES = mix(np.arange(1, 257, dtype=np.uint64))


def fragments(texts: list[bytes], least: int = LEAST, gram: int = GRAMS[0]):
    """Yield (text number, start, length, key, whether the key's string occurs in it twice) for all fragments of the texts."""
    wide = least - gram + 1
    part, size, first = [], 0, 0
    for k in range(len(texts) + 1):
        if k == len(texts) or (part and size + len(texts[k]) > SLICE):
            for i, s, n, key, inner in _fragments(part, least, gram, wide):
                yield first + i, s, n, key, inner
            part, size, first = [], 0, k
        if k < len(texts):
            part.append(texts[k])
            size += len(texts[k])


def _fragments(texts, least, gram, wide):
    if sum(map(len, texts)) < least:
        return
    if len(texts) == 1 and len(texts[0]) > 2 * SLICE:
        # slices of a very long text overlap by all but one byte of a window, so each window is in one slice
        for a in range(0, len(texts[0]) - least + 1, SLICE):
            for _, s, n, key, inner in _fragments([texts[0][a : a + SLICE + least - 1]], least, gram, wide):
                yield 0, a + s, n, key, inner
        return
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    h = mix(rolling(BYTES[np.frombuffer(b"".join(texts), np.uint8)], gram))
    low = sliding_min(h, wide)
    valid = np.zeros(len(low) + 1, np.int8)
    ok = ends - starts >= least
    np.add.at(valid, starts[ok], 1)
    np.add.at(valid, ends[ok] - least + 1, -1)
    inside = np.cumsum(valid)[:-1] > 0
    new = inside.copy()
    new[1:] &= (low[1:] != low[:-1]) | ~inside[:-1]
    new[starts[ok]] = True
    begin = np.flatnonzero(new)
    owner = np.searchsorted(starts, begin, side="right") - 1
    # empty texts share their start with the next one; the owner is the last that starts there, which isn't empty
    stop = np.minimum(np.append(begin[1:], len(low)), ends[owner] - least + 1)
    at = starts[owner]
    for b, e, o, s, key in zip(begin.tolist(), stop.tolist(), owner.tolist(), at.tolist(), low[begin]):
        yield o, b - s, e - b + least - 1, int(key), int(np.count_nonzero(h[b : e + wide - 1] == key) > 1)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


RECORD = "m bigint, fh bigint, a bigint, b bigint, at int, len int, inner int, once int"


def _add_records(out: dict, data: list[bytes], names, least: int, gram: int, content=slice(None)) -> None:
    """Append the fragments of ``data``; ``names(i)`` gives (key so far or None, a, b, place, once) of the i-th. ``content``: the part hashed."""
    digest = xxhash.xxh3_64_intdigest
    for i, s, n, key, inner in fragments(data, least, gram):
        m, a, b, at, once = names(i)
        if m is not None:
            key = digest(struct.pack("<qQ", m, key))
        for k, v in zip(out, (_signed(key), _signed(digest(data[i][s : s + n][content])), a, b, at + s, n, inner, once)):
            out[k].append(v)


def _empty() -> dict:
    return {c.split()[0]: [] for c in RECORD.split(", ")}


def _records(rows: DataFrame, least: int, gram: int) -> DataFrame:
    """The fragment records of all texts."""

    def run(batches):
        for a, b, texts in batches:
            for k in range(0, len(texts), 512):
                out = _empty()
                _add_records(out, [t.encode("utf-8", "surrogatepass") for t in texts[k : k + 512]], lambda i, k=k: (None, a[k + i], b[k + i], 0, 1), least, gram)
                yield out

    return map_batches(rows, ("a", "b", "text"), RECORD, run)


def _finer(found: DataFrame, least: int, gram: int) -> DataFrame:
    """The fragments of fetched fragments (m, a, b, at, once, data) by another gram; only equal old and new keys meet.

    With the window itself as the gram a fragment is a run of equal windows, of which the first one is hashed.
    """
    content = slice(least) if gram == least else slice(None)

    def run(batches):
        for m, a, b, at, once, data in batches:
            out = _empty()
            _add_records(out, data, lambda i: (m[i], a[i], b[i], at[i], once[i]), least, gram, content)
            yield out

    return map_batches(found, ("m", "a", "b", "at", "once", "data"), RECORD, run)


def _fetch(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of the wanted fragments (m, a, b, at, len, once), from one row of each name."""
    lists = wanted.groupBy("a", "b").agg(F.collect_list(F.struct("m", "at", "len", "once")).alias("x"))
    # rows of one name lie together after the join, so that dropping all but one needs no further exchange; the id comes along
    # so that the exchange of the rows is the one that the last join uses as well
    joined = rows.join(lists, ["a", "b"]).dropDuplicates(["a", "b"]).select("id", "text", "a", "b", "x.m", "x.at", "x.len", "x.once")

    def run(batches):
        for _, texts, a, b, m, at, size, once in batches:
            for k in range(len(texts)):
                data, n = texts[k].encode("utf-8", "surrogatepass"), len(m[k])
                yield {"m": m[k], "a": [a[k]] * n, "b": [b[k]] * n, "at": at[k], "once": once[k], "data": [data[s : s + z] for s, z in zip(at[k], size[k])]}

    return map_batches(joined, ("id", "text", "a", "b", "m", "at", "len", "once"), "m bigint, a bigint, b bigint, at int, once int, data binary", _merge_small(run))


def _merge_small(fn, rows: int = 2000):
    """Join up the small results of ``fn`` so that Arrow batches stay of a useful size."""

    def run(batches):
        held: dict[str, list] = {}
        for out in fn(batches):
            for k, v in out.items():
                held.setdefault(k, []).extend(v)
            if len(held["m"] if "m" in held else next(iter(held.values()))) >= rows:
                yield held
                held = {}
        if held:
            yield held

    return run


def _indexed(found: DataFrame, least: int) -> DataFrame:
    """Marks (a, b, s, e) of fragments that occur ``once``, from run-length indexes over blocks of whole key groups."""

    def marks(block):
        out = {"a": [], "b": [], "s": [], "e": []}
        for (a, b, at, once, _), spans in zip(block, RunIndex([x[4] for x in block]).repeats(least)):
            if once:
                for s, e in spans:
                    out["a"].append(a)
                    out["b"].append(b)
                    out["s"].append(at + s)
                    out["e"].append(at + e)
        return out

    def run(batches):
        block, size, group, group_size, key = [], 0, [], 0, None
        for lists in batches:
            for m, *row in zip(*lists):
                if m != key:
                    if size + group_size > MAX_BYTES:
                        yield marks(block)
                        block, size = [], 0
                    block += group
                    size += group_size
                    group, group_size, key = [], 0, m
                group.append(row)
                group_size += len(row[4]) + 1
        if block and size + group_size > MAX_BYTES:
            yield marks(block)
            block = []
        if block or group:
            yield marks(block + group)

    # the work is in Python and not in proportion to bytes: keep the partitions that coalescing by size would merge
    ordered = found.repartition(int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")), "m").sortWithinPartitions("m")
    return map_batches(ordered, ("m", "a", "b", "at", "once", "data"), "a bigint, b bigint, s int, e int", run)


def _sorted_out(records: DataFrame, hot_bytes: int) -> tuple[DataFrame, DataFrame]:
    """From records: (marks of fragments whose whole content occurs twice, fragments to be compared, with ``hot``)."""
    several = records.groupBy("m").agg(F.count("*").alias("n"), F.max("inner").alias("inner")).where("n > 1 OR inner = 1").select("m")
    live = cut(records.join(several, "m", "left_semi"))
    content = live.groupBy("m", "fh").agg(F.count("*").alias("n"), F.min(F.struct("a", "b", "at", "len", "inner", "once")).alias("x"))
    content = cut(content.select("m", "fh", "n", "x.*").withColumn("once", F.when(F.col("n") > 1, 0).otherwise(F.col("once"))))
    groups = content.groupBy("m").agg(
        F.count("*").alias("kinds"), F.max("inner").alias("some"), F.max("once").alias("open"), F.sum(F.col("len").cast("bigint") + 1).alias("bytes")
    )
    groups = groups.where("(kinds > 1 OR some = 1) AND open > 0").select("m", (F.col("bytes") > hot_bytes).alias("hot"))
    wanted = cut(content.join(groups, "m").select("m", "a", "b", "at", "len", "once", "hot"))
    copies = live.join(content.where("n > 1").select("m", "fh"), ["m", "fh"], "left_semi")
    return copies.select("a", "b", F.col("at").alias("s"), (F.col("at") + F.col("len")).alias("e")), wanted


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, grams: tuple[int, ...] = GRAMS, hot_bytes: int = HOT_BYTES) -> tuple[DataFrame, DataFrame]:
    """(rows, marks): rows (id, text, a, b), a and b being a row's 128-bit name; marks (a, b, s, e), spans of bytes that may overlap."""
    if not grams or list(grams) != sorted({*grams}) or not 0 < grams[0] <= grams[-1] <= least or hot_bytes > MAX_BYTES:
        raise ValueError("grams must rise within 1..least, and hot_bytes be a block at most")
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    rows = rows.select("id", "text", F.xxhash64("id").alias("a"), F.xxhash64("text", F.lit(1)).alias("b"))
    marks, records = None, _records(rows.where(F.octet_length("text") >= least), least, grams[0])
    for gram in (*grams[1:], least):
        copied, wanted = _sorted_out(records, hot_bytes)
        copied = copied.unionByName(_indexed(_fetch(rows, wanted.where("NOT hot").drop("hot")), least))
        marks = copied if marks is None else marks.unionByName(copied)
        if (hot := wanted.where("hot")).isEmpty():
            return rows, marks
        records = _finer(_fetch(rows, hot.drop("hot")), least, gram)
    # by whole windows: what agrees in key and content is one string
    twice = records.groupBy("m", "fh").agg(F.count("*").alias("n"), F.max("inner").alias("inner")).where("n > 1 OR inner = 1").select("m", "fh")
    last = records.where("once = 1").join(twice, ["m", "fh"], "left_semi").select("a", "b", F.col("at").alias("s"), (F.col("at") + F.col("len")).alias("e"))
    return rows, marks.unionByName(last)


def merge_spans(packed: list[int]) -> list[tuple[int, int]]:
    """Maximal spans from spans packed as start << 31 | end."""
    out: list[tuple[int, int]] = []
    for x in sorted(packed):
        s, e = x >> 31, x & 0x7FFFFFFF
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, grams: tuple[int, ...] = GRAMS, hot_bytes: int = HOT_BYTES, with_kept: bool = False, passage_words: int | None = None) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and, if ``with_kept``, ``text``: what is kept, without the
    parts of characters that a removed span cut. With ``passage_words`` also n_passages, n_passage_words: the maximal runs, and the words in them,
    of windows of so many words that other documents have too, of however few bytes (``word_passages``). They are counted, not removed."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows, marks = repeated_spans(docs, id_col, text_col, least, grams, hot_bytes)
    packed = F.shiftleft(F.col("s").cast("bigint"), 31).bitwiseOR(F.col("e").cast("bigint"))
    marks = marks.select("a", "b", packed.alias("x"))
    if passage_words:
        # spans of words are told from spans of bytes by their sign
        marks = marks.unionByName(passage_spans(rows, passage_words).select("a", "b", F.bitwise_not(packed).alias("x")))
    lists = marks.groupBy("a", "b").agg(F.collect_set("x").alias("x"))
    joined = rows.join(lists, ["a", "b"], "left").select("id", "text", "x")

    def run(batches):
        for ids, texts, packed in batches:
            out = {"id": ids, "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": []} | ({"text": []} if with_kept else {})
            out |= {"n_passages": [], "n_passage_words": []} if passage_words else {}
            for t, p in zip(texts, packed):
                data = t.encode("utf-8", "surrogatepass")
                spans, parts, at = merge_spans([x for x in p or [] if x >= 0]), [], 0
                for s, e in spans:
                    parts.append(data[at:s])
                    at = e
                kept = b"".join([*parts, data[at:]]) if spans else data
                out["n_bytes"].append(len(data))
                out["n_removed"].append(len(data) - len(kept))
                out["n_spans"].append(len(spans))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if with_kept:
                    out["text"].append(kept.decode("utf-8", "ignore") if spans else t)
                if passage_words:
                    shared = merge_spans([~x for x in p or [] if x < 0])
                    if shared and shared[-1][1] == OPEN_END:
                        n = len(data.split())
                        shared = [(0, n)] if n >= passage_words else []
                    out["n_passages"].append(len(shared))
                    out["n_passage_words"].append(sum(e - s for s, e in shared))
            yield out

    schema = f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", text string" * with_kept + ", n_passages bigint, n_passage_words bigint" * bool(passage_words)
    return map_batches(joined, ("id", "text", "x"), schema, run).withColumnRenamed("id", id_col)
