"""SimHash near-duplicates with bit-sliced comparison.

1. A scan gives each document its 64-bit fingerprint; only (id, fingerprint) goes on.
2. Equal fingerprints are counted together, so copies cost one row whatever their number.
3. Fingerprints are cut into ``blocks`` bands; two within ``radius`` bits agree on some
   ``blocks - radius`` of them, so each choice of that many bands gives a key. Rows with equal
   keys meet in a partition. More bands make longer keys: ``blocks`` grows with the number of
   distinct fingerprints so that buckets stay small; every choice is exact.
4. Members of a key with over ``chunk`` of them agree on its bits, so they differ in the others alone: these are
   cut into bands anew, and each choice of two of them makes a longer key. What still has over ``chunk`` members is
   split into chunks, and each pair of chunks is a bucket of its own, so no task gets an unbounded group.
5. Within a bucket the bits are held as vertical planes (one machine word has one bit of 64
   fingerprints). Shifting the planes by d compares each row with the d-th next one; seven planes at
   a time go through carry-save adders into bitwise counters, and words in which all lanes exceed the
   radius are abandoned.
6. A bucket emits one row per member (neighbours counted, local root), never its pairs; a pair
   counts only under the first key that its members share. Components are then joined up globally.

Defined cases: null, empty and blank texts have fingerprint 0 and link like any other. Repeated
rows count as further copies, also with equal ids. Null ids are kept; a component's id is the
smallest id that isn't null. An empty table gives an empty result. Texts are hashed whole.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import cut, fresh, map_batches, map_columns, text_or_empty
from corpusloom.llm.components import components

CHUNK = 4096
BATCH_ROWS = 1 << 17


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The SimHash of a text's word shingles as an unsigned 64-bit integer; 0 if it has no word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, 42)
    ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
    starts = [0, *(e + 1 for e in ends)]
    view, n = memoryview(joined), len(words) - shingle + 1
    hashes = np.fromiter((digest(view[a:b], 42) for a, b in zip(starts, ends[shingle - 1 :])), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 14):
        part = hashes[k : k + (1 << 14)]
        ones += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, fp): th is a 64-bit hash of the text, fp the fingerprint as a signed 64-bit integer."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return map_columns(
        rows.select("id", "text", F.xxhash64(text_or_empty("text")).alias("th")),
        ("id", "text", "th"),
        f"id {kind}, th bigint, fp bigint",
        lambda ids, texts, th: {"id": ids, "th": th, "fp": np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)},
    )


def _add(a, b, c):
    """A carry-save full adder over words: sum and carry."""
    x = a ^ b
    return x ^ c, (a & b) | (x & c)


def near_pairs(fps: np.ndarray, runs: np.ndarray, radius: int):
    """Index pairs (i, j), i < j, of rows of equal ``runs`` (a sorted key) whose fingerprints differ in at most ``radius`` (<= 6) bits."""
    n = len(fps)
    if n < 2:
        return
    bits = np.unpackbits(fps.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    rows = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    words = -(-n // 64)
    planes = np.zeros((64, words * 2 + 2), np.uint64)
    planes[:, :words].view(np.uint8)[:, : rows.shape[1]] = rows
    last = np.flatnonzero(np.append(runs[1:] != runs[:-1], True))
    left = last[np.searchsorted(last, np.arange(n))] - np.arange(n)  # rows of the run that follow
    for d in range(1, int(left.max()) + 1):
        lanes = np.zeros(words * 8, np.uint8)
        packed = np.packbits(left >= d, bitorder="little")
        lanes[: len(packed)] = packed
        alive = lanes.view(np.uint64)
        at = np.flatnonzero(alive)
        alive = alive[at]
        skip, by = d >> 6, np.uint64(d & 63)

        def differ(k, at=at):
            theirs = planes[k, at + skip]
            if by:
                theirs = (theirs >> by) | (planes[k, at + skip + 1] << (np.uint64(64) - by))
            return planes[k, at] ^ theirs

        c0 = c1 = c2 = over = np.zeros(len(at), np.uint64)
        for k in range(0, 64, 7):
            x = [differ(j, at) for j in range(k, min(k + 7, 64))]
            if len(x) == 7:
                s1, y1 = _add(x[0], x[1], x[2])
                s2, y2 = _add(x[3], x[4], x[5])
                one, y3 = _add(s1, s2, x[6])
                two, four = _add(y1, y2, y3)
            else:
                one, two, four = x[0], np.zeros_like(x[0]), np.zeros_like(x[0])
            carry = c0 & one
            c0 = c0 ^ one
            c1, carry = _add(c1, two, carry)
            c2, carry = _add(c2, four, carry)
            over = over | carry
            above, same = over, ~np.zeros_like(over)
            for c, bit in ((c2, 4), (c1, 2), (c0, 1)):
                if radius & bit:
                    same = same & c
                else:
                    above, same = above | (same & c), same & ~c
            alive = alive & ~above
            if not (keep := alive != 0).all():
                at, alive, c0, c1, c2, over = (v[keep] for v in (at, alive, c0, c1, c2, over))
                if not len(at):
                    break
        if len(at):
            w, b = np.nonzero(np.unpackbits(alive.view(np.uint8), bitorder="little").reshape(-1, 64))
            i = at[w] * 64 + b
            yield i, i + d


def _bucket(fps, counts, runs, side, first_key, radius):
    """Per row: how many others it links to (by their counts), and its root row. ``first_key(x)``: whether a pair belongs to this key."""
    n = len(fps)
    near, root = np.zeros(n, np.int64), np.arange(n)

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for i, j in near_pairs(fps, runs, radius):
        ok = first_key(i, j) & ((side[i] < 0) | (side[i] != side[j]))
        i, j = i[ok], j[ok]
        np.add.at(near, i, counts[j])
        np.add.at(near, j, counts[i])
        apart = root[i] != root[j]
        for a, b in zip(i[apart].tolist(), j[apart].tolist()):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        while apart.any() and (root[root] != root).any():
            root = root[root]
    return near, root


def masks(blocks: int, radius: int) -> list[int]:
    """A mask for each choice of ``blocks - radius`` of the bands."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    bands = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in combinations(bands, blocks - radius)]


def finer_masks(mask: int, radius: int) -> list[int]:
    """A mask for each choice of two of the ``radius + 2`` bands into which the bits outside ``mask`` are cut."""
    bits = [b for b in range(64) if not mask >> b & 1]
    n = radius + 2
    bands = [sum(1 << b for b in bits[len(bits) * k // n : len(bits) * (k + 1) // n]) for k in range(n)]
    return [sum(c) for c in combinations(bands, 2)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def blocks_for(n: int, radius: int) -> int:
    """The fewest bands for which ``n`` evenly spread fingerprints share a key with some hundreds of others at most; 6 at least for radius 4."""
    blocks = radius + 2
    while n >> (64 * (blocks - radius) // blocks) > 256 and blocks < radius + 5:
        blocks += 1
    return blocks


def link(fps: DataFrame, n_fps: int, radius: int = 4, chunk: int = CHUNK) -> DataFrame:
    """From distinct (fp, n): (fp, near, root) rows, partial, one or more per fingerprint with a neighbour."""
    keys = masks(blocks_for(n_fps, radius), radius)
    rows = fps.select("fp", "n", F.explode(F.array(*(F.struct(F.lit(k).alias("c"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for k, m in enumerate(keys)))).alias("x")).select("x.c", "x.key", "fp", "n")
    finer = [finer_masks(m, radius) for m in keys]
    crowd = lambda df, by: cut(df.groupBy(*by).count().where(F.col("count") > chunk).select(*by, F.ceil(F.col("count") / (chunk // 2)).cast("int").alias("parts")))
    whole = [F.lit(-1).alias("q"), F.lit(0).cast("bigint").alias("sub")]
    plain = [F.lit(-1).alias("side"), F.lit(0).alias("i"), F.lit(0).alias("j")]
    hot = crowd(rows, ["c", "key"])
    if hot.isEmpty():
        rows = rows.select("*", *whole, *plain)
    else:
        joined = rows.join(hot, ["c", "key"], "left")
        cold = joined.where("parts IS NULL").drop("parts").select("*", *whole)
        table = F.array(*(F.array(*(F.lit(signed(m)) for m in ms)) for ms in finer))
        longer = F.transform(F.element_at(table, F.col("c") + 1), lambda m, q: F.struct(q.cast("int").alias("q"), F.col("fp").bitwiseAND(m).alias("sub")))
        cut_again = joined.where("parts IS NOT NULL").select("c", "key", "fp", "n", F.explode(longer).alias("x")).select("c", "key", "fp", "n", "x.q", "x.sub")
        by = ["c", "key", "q", "sub"]
        joined = cut_again.join(crowd(cut_again, by), by, "left")
        cold = cold.unionByName(joined.where("parts IS NULL").drop("parts")).select("*", *plain)
        mine = joined.where("parts IS NOT NULL").withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        split = mine.select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        i, j = F.least("mine", "other"), F.greatest("mine", "other")
        rows = cold.unionByName(split.select(*by, "fp", "n", F.when(F.col("mine") == F.col("other"), -1).otherwise(F.col("mine")).alias("side"), i.alias("i"), j.alias("j")))
        # the bucket (i, i) compares a chunk with itself; in (i, j) only pairs across the two count
    group = ["c", "key", "q", "sub", "i", "j"]
    wide, narrow = [np.uint64(m) for m in keys], np.array(finer, np.uint64)

    def run(batches):
        held, size = [], 0

        def compare(part):
            c, _, q, _, _, _, fp, n, side, run_id = part
            fp = fp.view(np.uint64)

            def first_key(i, j):
                x, ok = fp[i] ^ fp[j], np.ones(len(i), bool)
                for k, m in enumerate(wide):
                    ok &= (c[i] <= k) | ((x & m) != 0)
                if (again := q[i] > 0).any():
                    for k in range(narrow.shape[1]):
                        ok &= ~again | (q[i] <= k) | ((x & narrow[c[i], k]) != 0)
                return ok

            near, root = _bucket(fp, n, run_id, side, first_key, radius)
            hit = near > 0
            return {"fp": fp.view(np.int64)[hit], "near": near[hit], "root": fp.view(np.int64)[root][hit]}

        def ready(parts, final):
            cols = [np.concatenate(x) for x in zip(*parts)]
            new = np.zeros(len(cols[0]), bool)
            for x in cols[: len(group)]:
                new[1:] |= x[1:] != x[:-1]
            stop = len(new) if final or not new.any() else int(np.flatnonzero(new)[-1])
            run_id = np.cumsum(new)
            return [*(x[:stop] for x in cols), run_id[:stop]], [x[stop:] for x in cols], new.any()

        for lists in batches:
            held.append([x.to_numpy(zero_copy_only=False).astype(np.int64) for x in lists])
            size += len(lists[0])
            if size >= BATCH_ROWS:
                part, rest, more = ready(held, False)
                if more:
                    yield compare(part)
                    held, size = [rest], len(rest[0])
        if size:
            yield compare(ready(held, True)[0])

    ordered = rows.repartition(*group).sortWithinPartitions(*group)
    return map_batches(ordered, [*group, "fp", "n", "side"], "fp bigint, near bigint, root bigint", run, as_lists=False)


def _classes(ids: DataFrame, radius: int, chunk: int) -> DataFrame:
    """Per fingerprint: (fp, n_near, root, first), root being the least fingerprint of its component and first its smallest id."""
    fps = cut(ids.groupBy("fp").agg(F.count("*").alias("n"), F.min("id").alias("first")))
    linked = cut(link(fps.select("fp", "n"), fps.count(), radius, chunk))
    near = linked.groupBy("fp").agg(F.sum("near").alias("near"))
    roots = components(linked.select(F.col("fp").alias("a"), F.col("root").alias("b")))
    return (
        fps.join(near, "fp", "left")
        .join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left")
        .select("fp", "first", (F.col("n") - 1 + F.coalesce("near", F.lit(0))).alias("n_near"), F.coalesce("root", "fp").alias("root"))
    )


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4, chunk: int = CHUNK) -> DataFrame:
    """One row per document: id, fingerprint (hex), n_near (others linked directly), component_id (smallest id reachable)."""
    ids = cut(fingerprints(docs, id_col, text_col).select("id", "fp"))
    known = _classes(ids, radius, chunk)
    least = known.groupBy("root").agg(F.min("first").alias("component_id"))
    per_fp = known.join(least, "root").select("fp", "n_near", "component_id")
    return ids.join(per_fp, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "n_near", "component_id"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4, chunk: int = CHUNK) -> DataFrame:
    """One row of ``docs``, with all its columns, of each group: that of the smallest id.

    Null ids come last; of equal ids the text of smaller hash stays, and of rows equal in id and text any one. The
    choice is made on (id, hashes) rows; texts move only in the last join.
    """
    name, hash_ = fresh(docs, "clm_name", "clm_hash")
    ids = cut(fingerprints(docs, id_col, text_col))
    roots = _classes(ids.select("id", "fp"), radius, chunk).select("fp", "root")
    first = ids.join(roots, "fp").groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "th")).alias("x"))
    # rows meet by two 64-bit hashes, of id and text, which are never null; equal rows then lie together already
    winners = first.select(F.xxhash64("x.id").alias(name), F.col("x.th").alias(hash_))
    hashed = docs.withColumns({name: F.xxhash64(id_col), hash_: F.xxhash64(text_or_empty(text_col))})
    return hashed.join(winners, [name, hash_], "left_semi").dropDuplicates([name, hash_]).drop(name, hash_)
