"""Byte-level BPE by backtracking over longest matches.

The vocabulary's tokens, their bytes mapped to Latin-1 characters, go into an Aho-Corasick trie.
A piece of text is encoded from left to right: take the longest token that matches, keep it if
the merges could have produced it next to the token before (a memoised compatibility test that
undoes the merges on both sides of the boundary), else fall back to the next shorter prefix token,
else drop the last token and go on from there; a bitmap of dead positions makes that linear.
The ids are exactly those of merging the pair of lowest rank again and again.

Ids for pieces (the matches of the splitting pattern) are memoised, in a table that is emptied
when it is full, so memory is bounded whatever the corpus holds.

Defined cases: a null text counts as empty, and an empty text has no ids. Special tokens are
ordinary text. Lone surrogates can't occur in Spark strings. Equal rows give equal results, an
empty table an empty result. A text is encoded whole, in time linear in its length.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from functools import lru_cache

import ahocorasick
import regex
from pyspark.sql import DataFrame

from corpusloom.llm.common import map_batches

NONE = -1


class BacktrackingBPE:
    """``ranks`` maps the bytes of each token to its rank, which is its id."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo_pieces: int = 400_000):
        self.token = {i: b for b, i in ranks.items()}
        self.ranks = ranks
        self.findall = regex.compile(pattern).findall
        self.memo_pieces = memo_pieces
        self.memo: dict[str, bytes] = {}
        self.compatible: dict[int, bool] = {}
        self.size = {i: len(b) for b, i in ranks.items()}
        self.widest = max(self.size.values(), default=1)
        self.by_text = {b.decode("latin-1"): i for b, i in ranks.items()}
        trie = ahocorasick.Automaton()
        for b, i in self.by_text.items():
            trie.add_word(b, i)
        self.trie = trie
        self.shorter = {i: self._prefix(b) for b, i in ranks.items()}
        self.split: dict[int, tuple[int, int]] = {}
        self.pairs: dict[tuple[int, int], int] = {}
        unreachable = []
        for i in sorted(self.token):
            b = self.token[i]
            left = self.shorter[i]
            while left != NONE:
                right = ranks.get(b[len(self.token[left]) :])
                if right is not None and left < i and right < i and self._fits(left, right):
                    self.pairs[left, right] = i
                    self.split[i] = (left, right)
                    break
                left = self.shorter[left]
            else:
                self.split[i] = (i, i)
                if len(b) > 1:
                    unreachable.append(i)
        # a token that no merges produce only ever stands for a whole piece
        for i in unreachable:
            trie.remove_word(self.token[i].decode("latin-1"))
            del self.by_text[self.token[i].decode("latin-1")]
        if unreachable:
            self.shorter = {i: self._prefix(b) for b, i in ranks.items()}
        self.compatible.clear()

    def _prefix(self, b: bytes) -> int:
        """The longest token that is a proper prefix of ``b``."""
        return next((i for k in range(len(b) - 1, 0, -1) if (i := self.trie.get((b[:k]).decode("latin-1"), NONE)) != NONE), NONE)

    def _fits(self, one: int, two: int) -> bool:
        """Whether merging would leave ``one`` and ``two`` side by side."""
        limit, split, pairs = 1 << 60, self.split, self.pairs
        while True:
            joined = pairs.get((one, two))
            if joined is not None and joined < limit:
                return False
            if one > two:
                limit = one
                one = split[one][1]
                if one == limit:
                    limit = two + 1
                    two = split[two][0]
                    if two + 1 == limit:
                        return True
            else:
                limit = two + 1
                two = split[two][0]
                if two + 1 == limit:
                    limit = one
                    one = split[one][1]
                    if one == limit:
                        return True

    def fits(self, one: int, two: int) -> bool:
        """``_fits``, memoised in a table that is emptied when it is full."""
        if len(self.compatible) >= 500_000:
            self.compatible.clear()
        known = self.compatible[one << 32 | two] = self._fits(one, two)
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        text, n = piece.decode("latin-1"), len(piece)
        size, widest, shorter, longest, by_text, known = self.size, self.widest, self.shorter, self.trie.longest_prefix, self.by_text, self.compatible.get
        alive = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        at, last, nxt = 0, NONE, NONE
        while at < n:
            if nxt == NONE:
                rest = text[at : at + widest]
                k = longest(rest)
                while (nxt := by_text.get(rest[:k], NONE)) == NONE:
                    k -= 1
            while True:
                end = at + size[nxt]
                if alive[end] and (last == NONE or (ok := known(last << 32 | nxt)) or (ok is None and self.fits(last, nxt))):
                    out.append(nxt)
                    at, last, nxt = end, nxt, NONE
                    break
                if (nxt := shorter[nxt]) == NONE:
                    # nothing leads on from here: try the next shorter token in place of the last one
                    alive[at] = 0
                    nxt = out.pop()
                    at -= size[nxt]
                    last = out[-1] if out else NONE
                    break
        return out

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        memo, parts = self.memo, []
        for piece in self.findall(text):
            ids = memo.get(piece)
            if ids is None:
                ids = array("I", self.encode_piece(piece.encode())).tobytes()
                if len(piece) <= 64:
                    if len(memo) >= self.memo_pieces:
                        memo.clear()
                    memo[piece] = ids
            parts.append(ids)
        return b"".join(parts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, memoryview(ids).cast("I")))


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> BacktrackingBPE:
    """The encoder for a rank file (base64 token, blank, rank on each line), built once in each worker."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return BacktrackingBPE(ranks, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256 and, if ``with_ids``, the ids themselves as binary. A scan, no shuffle."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        bpe = load(path, pattern)
        for names, texts in batches:
            ids = [bpe.encode(t or "") for t in texts]
            out = {
                "id": names,
                "n_tokens": [len(x) // 4 for x in ids],
                "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                "decoded_sha256": [hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids],
            }
            yield out | {"ids": ids} if with_ids else out

    out = map_batches(
        docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text"),
        ("id", "text"),
        f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids,
        run,
    )
    return out.withColumnRenamed("id", id_col)
