"""Token ids as binary files of patched frame-of-reference blocks.

A file holds a run of documents in ascending id order. Its ids are cut into blocks of ``BLOCK``;
a block stores its minimum, the differences from it packed at a width that a percentile of them
fits (``PERCENTILE``), and a list of exceptions (position, whole difference) for the rest. The end of
the file has the byte offset of every block and, for every document, its id and number of ids, so a
reader can seek to any document without unpacking the blocks before it.

Layout, little-endian: ``CLF1`` | blocks | u64 offset of each block | per document: i64 id, u8 null flag,
u64 ids | footer: u64 ids, u64 documents, u32 ids a block, u64 offset of the index, ``CLF1``.
A block: u32 minimum, u16 ids, u8 width, u16 exceptions, packed words of 64 bits, u16 positions, u32 values.

Rows are range-partitioned by id. Each partition writes one file, under a name of its own that is moved
into place when it is whole, so a task that is run again replaces it with the same content. A file's
first position follows from the sizes of the files before it: one row per file, never one per document.

Defined cases: a null text counts as empty and has the end id alone. Null ids come first. Rows with
equal ids follow each other by a hash of their text, which also tells ranges apart, so that many rows of one id
don't share a partition; equal rows are interchangeable. An empty table
gives no file and an empty result. A text's ids are held whole; a file is written block by block.
"""

from __future__ import annotations

import os
import string
import struct
import unicodedata
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from corpusloom.llm.common import SPACE_CHARS, cut, map_batches, shared_dir, text_or_empty

MAGIC = b"CLF1"
BLOCK = 4096
PERCENTILE = 0.98
HEAD = struct.Struct("<IHBH")
FOOT = struct.Struct("<QQIQ4s")


def pack_bits(v: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of each value, one after the other."""
    if not width:
        return b""
    bits = np.unpackbits(v.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little", count=width)
    return np.packbits(bits.reshape(-1), bitorder="little").tobytes()


def unpack_bits(data: bytes, n: int, width: int) -> np.ndarray:
    if not width:
        return np.zeros(n, np.uint32)
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little", count=n * width).reshape(n, width)
    full = np.zeros((n, 32), np.uint8)
    full[:, :width] = bits
    return np.packbits(full, axis=1, bitorder="little").view("<u4").reshape(n)


def pack_block(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """One block of 1 to 65,535 unsigned 32-bit ids."""
    low = int(ids.min())
    gap = (ids - np.uint32(low)).astype(np.uint32)
    rank = min(len(gap) - 1, int(percentile * len(gap)))
    width = int(np.partition(gap, rank)[rank]).bit_length()
    odd = np.flatnonzero(gap >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    return b"".join((HEAD.pack(low, len(ids), width, len(odd)), pack_bits(gap, width), odd.astype("<u2").tobytes(), gap[odd].astype("<u4").tobytes()))


def unpack_block(data: bytes, at: int = 0) -> np.ndarray:
    low, n, width, odd = HEAD.unpack_from(data, at)
    at += HEAD.size
    size = -(-n * width // 8)
    gap = unpack_bits(data[at : at + size], n, width)
    at += size
    where = np.frombuffer(data, "<u2", odd, at)
    gap[where] = np.frombuffer(data, "<u4", odd, at + 2 * odd)
    return gap + np.uint32(low)


class FileWriter:
    """Writes documents' ids to a binary stream, a block at a time."""

    def __init__(self, out):
        self.out, self.at, self.held, self.size, self.total = out, len(MAGIC), [], 0, 0
        self.offsets: list[int] = []
        self.docs: list[tuple[int | None, int]] = []
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= BLOCK:
            self._flush(False)

    def _flush(self, final: bool) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        stop = len(ids) if final else len(ids) - len(ids) % BLOCK
        for k in range(0, stop, BLOCK):
            block = pack_block(ids[k : min(k + BLOCK, stop)])
            self.offsets.append(self.at)
            self.out.write(block)
            self.at += len(block)
        self.total += stop
        self.held, self.size = [ids[stop:]], len(ids) - stop

    def close(self) -> None:
        self._flush(True)
        self.out.write(np.asarray(self.offsets, "<u8").tobytes())
        self.out.write(np.asarray([d or 0 for d, _ in self.docs], "<i8").tobytes())
        self.out.write(bytes(d is None for d, _ in self.docs))
        self.out.write(np.asarray([n for _, n in self.docs], "<u8").tobytes())
        self.out.write(FOOT.pack(self.total, len(self.docs), BLOCK, self.at, MAGIC))


def read_file(source):
    """Yield (document id, first position in the file, ids) for each document of a seekable stream, block by block."""
    size = source.seek(0, 2)
    source.seek(size - FOOT.size)
    total, docs, block, index, magic = FOOT.unpack(source.read(FOOT.size))
    if magic != MAGIC:
        raise ValueError("not a token file")
    source.seek(index)
    blocks = -(-total // block)
    offsets = [*np.frombuffer(source.read(8 * blocks), "<u8").tolist(), index]
    names = np.frombuffer(source.read(8 * docs), "<i8").tolist()
    nulls = source.read(docs)
    sizes = np.frombuffer(source.read(8 * docs), "<u8").tolist()
    parts, held, nxt, start = [], 0, 0, 0
    for name, null, n in zip(names, nulls, sizes):
        while held < n:
            source.seek(offsets[nxt])
            parts.append(unpack_block(source.read(offsets[nxt + 1] - offsets[nxt])))
            held += len(parts[-1])
            nxt += 1
        flat = parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        yield (None if null else name), start, flat[:n]
        parts, held, start = [flat[n:]], held - n, start + n


def open_fs(uri: str):
    """The file system of a URI (or of a local path) and the path in it."""
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri.removeprefix('file:')}")


#: Stands between words that go to the library together; a word that has it goes by itself.
MARK = "\x01"


#: The characters that stand for bytes in byte-level models: those that can be seen, and for the others what comes from U+0100 on.
_SEEN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_SIGNS = {b: chr(b) for b in _SEEN} | {b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in _SEEN)}
#: Words in small letters of scripts in which models differ.
SAMPLES = ["a", "the", "abcdefghijklmnop", "qzxj", "don", "été", "straße", "naïveté", "ñandú", "привет", "λόγος", "ありがとう", "中文", "한국어", "שלום", "ª", "ǆ"]


class WordTokenizer:
    """The ids of a ``tokenizers`` model that lower-cases and drops white space.

    In such a model words between blanks don't influence each other. Arrow splits a batch of texts into words and
    numbers the different ones; the library encodes those that the memo lacks, many in a call with a mark between
    them; NumPy puts the texts' ids together. ``tests/llm`` holds this against encoding whole texts. Words that are all
    ASCII share the memo's entry with their small letters; others stand as they are, since the model composes letters
    before it lower-cases. Added tokens in a text get the ids of their own that the library gives them: it finds them
    before it lower-cases, so what only becomes one in small letters stands as it is too. The memo is emptied when it is full.
    """

    def __init__(self, path: str, memo_words: int = 600_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism here
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.added = [t.content for t in self.model.get_added_tokens_decoder().values()]
        if any(set(t) & set(SPACE_CHARS) for t in self.added):
            raise ValueError("an added token has white space")
        self.memo_words = memo_words
        self.memo: dict[str, bytes] = {}
        mark = self.model.encode(MARK, add_special_tokens=False).ids
        if len(mark) != 1:
            raise ValueError("the model has no single id for the mark between words")
        self.mark = mark[0]

        self.straight = self._straight()
        # a run of these after letters is a piece of its own to the model, so such words are put together from two entries
        pieces = lambda t: [x for x, _ in self.model.pre_tokenizer.pre_tokenize_str(t)] if self.model.pre_tokenizer else []
        whole = pieces("ab")
        self.tails = "".join(c for c in string.punctuation if len(whole) == 1 and pieces(f"ab{c}{c}") == [*whole, *pieces(c + c)] and len(pieces(c + c)) == 1)

    def _learn(self, new: list[str]) -> None:
        """Put the words into the memo: letters and a tail of punctuation from their parts, others as the library encodes them.

        Letters that in small letters aren't letters alone, as a capital I with a dot, might give a mark to the tail.
        """
        split = [(w, stem) for w in new if (stem := w.rstrip(self.tails)) != w and stem.isalpha() and stem.lower().isalpha()]
        parts = dict.fromkeys(x for w, stem in split for x in (stem, w[len(stem) :]))
        apart = {w for w, _ in split}
        self._encode([w for w in dict.fromkeys([*parts, *(w for w in new if w not in apart)]) if w not in self.memo])
        memo = self.memo
        for w, stem in split:
            memo[w] = memo[stem] + memo[w[len(stem) :]]

    def _piece(self, word: str) -> bytes:
        """The ids of a word that the model leaves as it is and takes for one piece: its bytes, as characters, straight to the merges."""
        return np.fromiter((t.id for t in self.model.model.tokenize(word.encode().decode("latin-1").translate(BYTE_SIGNS))), "<u4").tobytes()

    def _straight(self) -> bool:
        """Whether ``_piece`` gives what the library gives: for byte-level models that keep letters together, which samples of many scripts show."""
        try:
            return all(self._piece(w) == np.asarray(self.model.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in SAMPLES)
        except Exception:  # a model of another kind; it says so in ways of its own
            return False

    def _encode(self, new: list[str]) -> None:
        if self.straight:
            rest, memo, piece = [], self.memo, self._piece
            for w in new:
                if w.isalpha() and (w.isascii() and w.islower() or w == w.lower() and unicodedata.is_normalized("NFC", w)):
                    memo[w] = piece(w)
                else:
                    rest.append(w)
            new = rest
        for k in range(0, len(new), 4096):
            part = new[k : k + 4096]
            apart = [w for w in part if MARK in w]
            part = [w for w in part if MARK not in w]
            ids = np.asarray(self.model.encode_batch_fast([f" {MARK} ".join([*part, ""])], add_special_tokens=False)[0].ids, "<u4")
            data, at = ids.tobytes(), 0
            for w, e in zip(part, (np.flatnonzero(ids == self.mark) * 4).tolist()):
                self.memo[w] = data[at:e]
                at = e + 4
            for w in apart:
                self.memo[w] = np.asarray(self.model.encode(w, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and where each text's begin (and the last one's end) among them. No text is null."""
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        as_is, small = coded.dictionary, pc.ascii_lower(coded.dictionary)
        plain = pc.string_is_ascii(as_is)
        for t in self.added:
            plain = pc.and_not(plain, pc.match_substring(small, t.lower()))
        words = pc.if_else(plain, small, as_is).to_pylist()
        if len(self.memo) > self.memo_words:
            self.memo = {}
        memo = self.memo
        self._learn([w for w in dict.fromkeys(words) if w not in memo])
        parts = [memo[w] for w in words]
        table = np.frombuffer(b"".join(parts), "<u4")
        size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        start = np.cumsum(size) - size
        index = coded.indices.to_numpy(zero_copy_only=False)
        n = size[index]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        kind = np.int32 if total < 2**31 else np.int64
        ids = table[np.repeat((start[index] - (ends - n)).astype(kind), n) + np.arange(total, dtype=kind)]
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        return ids, np.concatenate([[0], ends])[offsets]


@lru_cache(maxsize=2)
def load(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def _range_parts(docs: DataFrame) -> int:
    """Files to write: as many as the session has shuffle partitions."""
    return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", texts_a_batch: int = 4096) -> DataFrame:
    """Write one file per range of ids under ``folder``; returns (part, file, n_ids, n_docs), one row per file that has documents."""
    ordered = (
        docs.select(F.col(id_col).cast("bigint").alias("id"), text_or_empty(text_col).alias("text"))
        .withColumn("th", F.xxhash64("text"))
        .repartitionByRange(_range_parts(docs), F.col("id").asc_nulls_first(), "th")
        .sortWithinPartitions(F.col("id").asc_nulls_first(), "th", "text")
        .withColumn("part", F.spark_partition_id())
    )

    def run(batches):
        tok = load(tokenizer_path)
        fs, root = open_fs(folder)
        writer, out = None, None
        end = np.array([end_id], "<u4")
        for ids, texts, parts in batches:
            if writer is None and len(ids):
                part = parts[0].as_py()
                draft = f"{root}/.part-{part:06d}-{uuid.uuid4().hex}"
                out = fs.open_output_stream(draft)
                writer = FileWriter(out)
            for k in range(0, len(ids), texts_a_batch):
                tokens, at = tok.encode(texts.slice(k, texts_a_batch))
                for i, a, b in zip(ids.slice(k, texts_a_batch).to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                    writer.add(i, np.concatenate([tokens[a:b], end]))
        if writer:
            writer.close()
            out.close()
            name = f"{root}/part-{part:06d}.clf"
            fs.move(draft, name)
            yield {"part": [part], "file": [name], "n_ids": [writer.total], "n_docs": [len(writer.docs)]}

    _, root = open_fs(folder)
    open_fs(folder)[0].create_dir(root, recursive=True)
    # the action that runs the writers; the rows are one per file
    return cut(map_batches(ordered, ("id", "text", "part"), "part int, file string, n_ids bigint, n_docs bigint", run, as_lists=False))


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    # the window is over one row per file, so over as many rows as the writer had partitions
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    rows = manifest.select("part", "file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    parts = _range_parts(manifest)

    def run(batches):
        fs, _ = open_fs(folder)
        for names, bases in batches:
            for name, base in zip(names, bases):
                docs, start, size, crc = [], [], [], []
                with fs.open_input_file(name) as source:
                    for d, s, ids in read_file(source):
                        docs.append(d)
                        start.append(base + s)
                        size.append(len(ids))
                        crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                        if len(docs) == 10_000:
                            yield {"doc_id": docs, "start": start, "n_tokens": size, "ids_crc32": crc}
                            docs, start, size, crc = [], [], [], []
                yield {"doc_id": docs, "start": start, "n_tokens": size, "ids_crc32": crc}

    # by number, so that each task gets its share of the files
    return map_batches(rows.repartitionById(parts, "part"), ("file", "base"), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint", run)


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` as token files in the shared folder and read them back."""
    folder = f"{shared_dir(docs.sparkSession)}/token-files-{uuid.uuid4().hex}"
    out = read_token_files(write_token_files(docs, tokenizer_path, folder, end_id, id_col, text_col), folder)
    return out.withColumnRenamed("doc_id", id_col)
