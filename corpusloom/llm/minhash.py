"""One-permutation MinHash fingerprints.

Each shingle (``shingle`` code points; a shorter text is one shingle) is hashed once. The hash's top bits
choose one of ``BINS`` bins, which keeps the least of the rest. Empty bins are filled by optimal
densification: a bin tries the bins of its own hash sequence until one isn't empty and copies
its value. The ``BITS`` low-order bits of the values are packed. From the share m of equal fields,
the likeness is (m - r) / (1 - r), r = 2 ** -BITS being the chance of equal bits.

Defined cases: null and empty texts have the empty string as fingerprint, of likeness 1 to each other and 0
to all others. Equal texts have equal fingerprints. An empty table gives an empty result.
Texts are hashed whole, in slices when they are very long.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import map_batches, text_or_empty

BINS = 256
BITS = 4
SHINGLE = 12
TRIES = 2048
EMPTY = np.uint64(2**64 - 1)
BASE = 0x9E3779B97F4A7C15 | 1
MASK = 2**64 - 1


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit words."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def rolling(codes: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hashes, modulo 2**64, of each k items in a row; ``k`` is made of doublings."""
    out, done, power, size = None, 0, codes, 1
    bits = k
    while bits:
        if bits & 1:
            if out is None:
                out, done = power, size
            else:
                m = len(codes) - done - size + 1
                out = out[:m] * np.uint64(pow(BASE, size, 1 << 64)) + power[done : done + m]
                done += size
        bits >>= 1
        if bits:
            m = len(power) - size
            power = power[:m] * np.uint64(pow(BASE, size, 1 << 64)) + power[size : size + m]
            size *= 2
    return out


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """The least of each ``w`` items in a row, by prefix and suffix minima of blocks of ``w``."""
    n = len(h) - w + 1
    blocks = -(-len(h) // w)
    full = np.full(blocks * w, np.uint64(2**64 - 1))
    full[: len(h)] = h
    full = full.reshape(blocks, w)
    ahead = np.minimum.accumulate(full, axis=1).reshape(-1)
    back = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


PROBE = (mix(np.arange(BINS * 64, dtype=np.uint64) + np.uint64(0x51ED270B)) % np.uint64(BINS)).astype(np.int64).reshape(64, BINS)


def probe(t: int) -> np.ndarray:
    """The t-th bin that each bin tries."""
    if t < len(PROBE):
        return PROBE[t]
    return (mix(np.arange(BINS, dtype=np.uint64) + np.uint64(t * BINS + 0x51ED270B)) % np.uint64(BINS)).astype(np.int64)


def densify(bins: np.ndarray) -> None:
    """Fill the empty bins of each row, in place; rows without any value stay as they are."""
    full = bins != EMPTY
    row, col = np.nonzero(~full & full.any(axis=1)[:, None])
    for t in range(TRIES):
        if not len(row):
            return
        from_ = probe(t)[col]
        ok = full[row, from_]
        bins[row[ok], col[ok]] = bins[row[ok], from_[ok]]
        row, col = row[~ok], col[~ok]
    for r, c in zip(row.tolist(), col.tolist()):  # next to impossible: take the next full bin
        bins[r, c] = bins[r, (c + 1 + int(np.argmax(np.roll(full[r], -c - 1)))) % BINS]


def _signatures(texts: list[str], shingle: int) -> np.ndarray:
    bins = np.full(len(texts) * BINS, EMPTY)
    codes = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
    starts = np.cumsum([0, *map(len, codes)])
    flat = np.concatenate(codes).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    shift = np.uint64(64 - BINS.bit_length() + 1)

    def put(rows, h):
        np.minimum.at(bins, rows * BINS + (h >> shift).astype(np.int64), h & ((np.uint64(1) << shift) - np.uint64(1)))

    step = 1 << 20
    for a in range(0, len(flat), step):
        part = flat[a : a + step + shingle - 1]
        if len(part) < shingle:
            break
        h = mix(rolling(part, shingle))
        at = np.arange(a, a + len(h))
        rows = np.searchsorted(starts, at, side="right") - 1
        inside = at + shingle <= starts[rows + 1]
        put(rows[inside], h[inside])
    short = [i for i, c in enumerate(codes) if 0 < len(c) < shingle]
    if short:
        put(np.array(short), mix(np.array([xxhash.xxh64_intdigest(texts[i].encode("utf-8", "surrogatepass"), 7) for i in short], np.uint64)))
    bins = bins.reshape(len(texts), BINS)
    densify(bins)
    # another mix, so that the low-order bits don't follow from a bin's least value being small
    return (mix(bins) & np.uint64((1 << BITS) - 1)).astype(np.uint8)


def signatures(texts: list[str], shingle: int = SHINGLE) -> np.ndarray:
    """A row of ``BINS`` small integers per text; rows of empty texts mean nothing."""
    out, part, size = [np.zeros((0, BINS), np.uint8)], [], 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= 1 << 18 or len(part) >= 512:
            out.append(_signatures(part, shingle))
            part, size = [], 0
    if part:
        out.append(_signatures(part, shingle))
    return np.concatenate(out)


def pack(sig: np.ndarray) -> str:
    """A signature as lowercase hex, the first bin's bits in front."""
    bits = np.unpackbits(sig[:, None], axis=1, bitorder="big")[:, 8 - BITS :]
    return np.packbits(bits.reshape(-1), bitorder="big").tobytes().hex()


def unpack(fingerprint: str) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(bytes.fromhex(fingerprint), np.uint8), bitorder="big").reshape(BINS, BITS)
    return np.packbits(bits, axis=1, bitorder="big").reshape(-1) >> (8 - BITS)


def likeness_of(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Bias-corrected likeness of signatures, row by row."""
    r = 2.0**-BITS
    return np.clip(((one == two).mean(axis=-1) - r) / (1 - r), 0.0, 1.0)


def likeness(one: str, two: str) -> float:
    if not one or not two:
        return float(one == two)
    return float(likeness_of(unpack(one), unpack(two)))


def edit(text: str, following: str) -> str:
    """The last quarter of the code points gives way to as many of the start of ``following``."""
    q = len(text) // 4
    return text[: len(text) - q] + following[:q]


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Per document: n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is that of the next greater id (after the last, the first; a lone document follows
    itself). Null ids come first; rows with equal ids follow each other by a hash of their text, then by text. Ids are
    split into ranges at approximate quantiles, and an id at which several quantiles lie into as many ranges of that hash;
    each range is sorted by itself and gets the first document of the range after it as a closing row: one short
    table of a row per range, whatever the input's size.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(2**63))).alias("key"))
    rows = rows.withColumn("th", F.xxhash64("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # quantiles come as doubles; they and the ids are compared as whole numbers, so that ids that are equal as doubles keep their order
    cuts = sorted(int(max(-(2.0**63), min(c, 2.0**63 - 1024))) for c in docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(-(2**63))).cast("double").alias("key")).approxQuantile("key", [k / parts for k in range(1, parts)], 0.2 / parts))
    bounds, key = F.array(*map(F.lit, cuts)).cast("array<bigint>"), F.col("key")
    times = F.size(F.filter(bounds, lambda b: b == key))
    share = F.least(times, F.floor((F.col("th") / F.lit(2.0**64) + 0.5) * (times + 1)))
    rows = rows.select("id", "text", "key", "th", (F.size(F.filter(bounds, lambda b: b < key)) + share).cast("int").alias("part"))
    # a row per range
    least = sorted((r.part, r.x.key, r.x.th) for r in rows.groupBy("part").agg(F.min(F.struct("key", "th")).alias("x")).collect())
    heads = rows.where(F.col("key").isin([k for _, k, _ in least]) & F.col("th").isin([h for *_, h in least])).groupBy("key", "th").agg(F.min("text").alias("text"))
    after = spark.createDataFrame([(p, *least[(i + 1) % len(least)][1:]) for i, (p, *_) in enumerate(least)], "part int, key bigint, th bigint")
    closing = after.join(heads, ["key", "th"]).select(F.lit(None).cast(kind).alias("id"), "text", "key", "th", "part", F.lit(1).alias("closing"))
    ordered = (
        rows.select("id", "text", "key", "th", "part", F.lit(0).alias("closing"))
        .unionByName(closing)
        .repartitionById(parts, "part")
        .sortWithinPartitions("part", "closing", "key", "th", "text")
    )

    def run(batches):
        held = None
        for ids, texts, flags in batches:
            for k in range(0, len(ids), 1024):
                i, t, f = ids[k : k + 1024], texts[k : k + 1024], flags[k : k + 1024]
                sig = signatures(t, shingle)
                if held:
                    i, t, f, sig = [held[0], *i], [held[1], *t], [held[2], *f], np.concatenate([held[3], sig])
                held = (i[-1], t[-1], f[-1], sig[-1:])
                own = [n for n in range(len(i) - 1) if not f[n]]
                if not own:
                    continue
                edited = [edit(t[n], t[n + 1]) for n in own]
                other = signatures(edited, shingle)
                at = np.array(own)
                here, there = np.array([bool(t[n]) for n in own]), np.array([bool(t[n + 1]) for n in own])
                near = np.where(here & there, likeness_of(sig[at], sig[at + 1]), (here == there).astype(float))
                yield {
                    "id": [i[n] for n in own],
                    "n_chars": [len(t[n]) for n in own],
                    "edited_sha256": [hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited],
                    "fingerprint": [pack(sig[n]) if t[n] else "" for n in own],
                    "edited_fingerprint": [pack(s) if e else "" for s, e in zip(other, edited)],
                    # an edit never empties a text: at most a quarter of it goes
                    "near_edited": np.where(here, likeness_of(sig[at], other), 1.0),
                    "near_next": near,
                }

    out = map_batches(
        ordered,
        ("id", "text", "closing"),
        f"id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
        run,
    )
    return out.withColumnRenamed("id", id_col)
