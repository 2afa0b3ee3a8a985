"""The elements of a list in one large JSON document, cut out by many tasks.

A piece of the document can't tell by itself whether it begins in a string or how deep. So tasks first say for each piece what it changes, begun
in a string or not; the driver adds that up, a short row a piece; then tasks find which list each piece begins in, and last cut the elements
that begin in their piece.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a piece.
PIECE = 1 << 22
#: Bytes looked at for the key before a list, and elements given away at a time.
BACK, CUT = 4096, 10_000
SPACE = b" \t\r\n"


def read_at(uri: str, start: int, size: int) -> bytes:
    from corpusloom.sources.files import open_fs

    fs, path = open_fs(uri)
    with fs.open_input_file(path) as source:
        source.seek(start)
        return source.read(size)


def _escaped(uri: str, start: int) -> bool:
    """Whether an odd number of backslashes ends just before ``start``."""
    n, step = 0, 64
    while start - n > 0:
        head = read_at(uri, max(0, start - n - step), min(step, start - n))
        kept = len(head.rstrip(b"\\"))
        n += len(head) - kept
        if kept:
            break
        step *= 2
    return n % 2 == 1


def marks(data: bytes, escaped: bool) -> tuple[np.ndarray, np.ndarray]:
    """(places of the quotes that begin or end strings, places of brackets and commas, in strings too)."""
    b = np.frombuffer(data, np.uint8)
    quotes = np.flatnonzero(b == 34)
    if escaped or (b == 92).any():
        other = np.maximum.accumulate(np.where(b != 92, np.arange(len(b)), -1))
        run = np.where(quotes > 0, quotes - 1 - other[quotes - 1], 0)
        run += escaped & (run == quotes)  # backslashes up to the start go on before it
        quotes = quotes[run % 2 == 0]
    return quotes, np.flatnonzero((b == 123) | (b == 125) | (b == 91) | (b == 93) | (b == 44))


def depths(data: bytes, escaped: bool, inside: int, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(places outside strings, what each adds to the depth, the depth after it, whether the data ends in a string)."""
    quotes, at = marks(data, escaped)
    at = at[(np.searchsorted(quotes, at) + inside) % 2 == 0]
    c = np.frombuffer(data, np.uint8)[at]
    step = np.where(c == 44, 0, np.where((c == 123) | (c == 91), 1, -1))
    return at, step, depth + np.cumsum(step), (inside + len(quotes)) % 2


def change(uri: str, start: int, size: int) -> tuple[int, int, int, bool]:
    """(1 if the piece ends otherwise than it begins, in a string or not; depth added if it begins outside; or inside a string; whether it looks like UTF-8 from its head)."""
    data, escaped = read_at(uri, start, size), _escaped(uri, start)
    outside, within = (depths(data, escaped, k, 0) for k in (0, 1))
    first = data[:4]
    plain = start > 0 or not (first[:2] in (b"\xff\xfe", b"\xfe\xff") or b"\0" in first) and data.lstrip(SPACE).removeprefix(b"\xef\xbb\xbf").lstrip(SPACE)[:1] == b"{"
    return int(outside[3]), int(outside[1].sum()), int(within[1].sum()), plain


def lists(uri: str, start: int, size: int, inside: int, depth: int, name: str) -> tuple[int | None, int, bool]:
    """(whether the last list or object that begins in the piece one level down is the list ``name``; how many are; whether all could be told)."""
    data = read_at(uri, start, size)
    at, step, level, _ = depths(data, _escaped(uri, start), inside, depth)
    last, n, sure = None, 0, bool((level >= 0).all()) and not ((level == 0) & (step < 0))[:-1].any()
    for p in at[(step > 0) & (level == 2)].tolist():
        back = data[p - BACK : p] if p >= BACK else read_at(uri, max(0, start + p - BACK), min(BACK, start + p))
        key = back.rstrip(SPACE)
        key = key[:-1].rstrip(SPACE) if key.endswith(b":") else b""
        sure &= key.endswith(b'"') and not re.search(rb'\\u[0-9a-fA-F]{4}[^"]*"$', key)
        last = int(data[p : p + 1] == b"[" and re.search(rb'(?<!\\)"' + re.escape(name.encode()) + rb'"$', key) is not None)
        n += last
    return last, n, bool(sure)


def elements(uri: str, start: int, size: int, inside: int, depth: int, here: int, name: str):
    """(place, text) of the elements of the list ``name`` that begin in the piece; the last one is read on until it ends."""
    more, escaped = 0, _escaped(uri, start)
    while True:
        data = read_at(uri, start, size + more)
        at, step, level, _ = depths(data, escaped, inside, depth)
        cut = (level == 2) & (step >= 0) | (level == 1) & (step < 0)
        at, step = at[cut], step[cut]
        if not len(at) or at[-1] >= size or step[-1] < 0 or len(data) < size + more:
            break
        more = max(2 * more, 1 << 16)
    mine, k = here, 0
    for p, s, end in zip(at.tolist(), step.tolist(), at[1:].tolist() + [None]):
        if p >= size:
            break
        if s > 0:
            back = data[max(0, p - BACK) : p] if p >= BACK else read_at(uri, max(0, start + p - BACK), min(BACK, start + p))
            mine, k = int(data[p : p + 1] == b"[" and re.search(rb'(?<!\\)"' + re.escape(name.encode()) + rb'"\s*:\s*$', back) is not None), 0
        if mine and s >= 0 and end is not None:
            text = data[p + 1 : end].strip(SPACE)
            if text:
                yield start + p, text.decode("utf-8", "replace")
        if s < 0:
            mine = 0


def cut_list(spark: SparkSession, listed: DataFrame, name: str, piece: int = PIECE) -> DataFrame | None:
    """(path, at, text): the elements of the list ``name`` of the object that each file of (path, size_bytes) is; None if one isn't in UTF-8, isn't
    whole, or is of another form, which is left to a reader of whole documents.
    """
    found = listed.where("size_bytes > 0").select("path", "size_bytes", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("size_bytes") - 1, F.lit(piece).cast("bigint"))).alias("start"))
    found = found.select("path", "start", F.least(F.lit(piece), F.col("size_bytes") - F.col("start")).alias("size"))

    def each(rows: DataFrame, of, schema: str, columns: list[str]) -> DataFrame:
        n = max(1, min(rows.count(), 4 * spark.sparkContext.defaultParallelism))

        def run(batches):
            for b in batches:
                for row in zip(*(b.column(c).to_pylist() for c in columns)):
                    yield from of(*row)

        return rows.repartition(n).mapInArrow(run, schema)

    def one(of, names, kinds):
        def run(uri, start, *rest):
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((uri, start, *of(uri, start, *rest)), (pa.string(), pa.int64(), *kinds))], names=["path", "start", *names])

        return run

    first = each(found, one(change, ["turn", "outside", "within", "plain"], [pa.int64()] * 3 + [pa.bool_()]), "path string, start bigint, turn bigint, outside bigint, within bigint, plain boolean", ["path", "start", "size"])
    begun, path, sizes = [], None, {(r.path, r.start): r.size for r in found.collect()}  # a short row a piece, here and below
    for r in sorted(first.collect(), key=lambda r: (r.path, r.start)):
        if r.path != path:
            if path is not None and (inside or depth):  # noqa: F821
                return None
            path, inside, depth = r.path, 0, 0
        if not r.plain:
            return None
        begun.append((r.path, r.start, sizes[r.path, r.start], inside, depth))
        inside, depth = (inside + r.turn) % 2, depth + (r.within if inside else r.outside)
    if not begun:
        return spark.createDataFrame([], "path string, at bigint, text string")
    if inside or depth:
        return None
    states = spark.createDataFrame(begun, "path string, start bigint, size bigint, inside bigint, depth bigint")
    names = ["path", "start", "size", "inside", "depth"]
    second = each(states, one(lambda *x: lists(*x, name), ["last", "n", "sure"], [pa.int64(), pa.int64(), pa.bool_()]), "path string, start bigint, last bigint, n bigint, sure boolean", names)
    told = {(r.path, r.start): r for r in second.collect()}
    path, rows = None, []
    for x in begun:
        r = told[x[:2]]
        if x[0] != path:
            path, here, n = x[0], 0, 0
        elif x[4] == 0:  # something follows the object
            return None
        n += r.n
        if not r.sure or n > 1:
            return None
        rows.append((*x, here))
        here = here if r.last is None else r.last

    def cut(uri, *rest):
        out: list[tuple[int, str]] = []
        pack = lambda: pa.RecordBatch.from_arrays([pa.array([uri] * len(out)), pa.array([p for p, _ in out], pa.int64()), pa.array([t for _, t in out])], names=["path", "at", "text"])
        for x in elements(uri, *rest, name):
            out.append(x)
            if len(out) == CUT:
                yield pack()
                out = []
        if out:
            yield pack()

    return each(spark.createDataFrame(rows, "path string, start bigint, size bigint, inside bigint, depth bigint, here bigint"), cut, "path string, at bigint, text string", [*names, "here"])
