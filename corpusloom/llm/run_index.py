"""A run-length index of a block of texts and its matching statistics.

The suffixes of a block are sorted by rank tripling; their preceding bytes form the block's
Burrows-Wheeler transform, of which only the runs are kept, with the text positions at both ends of each
run (sampled run ends). Two neighbours inside a run are preceded by the same byte, so what they share
is what the neighbours one byte to the left share, less that byte; only at run ends does a longest common
extension have to be worked out. Streaming over the text from left to right with "one less than before, or
the sample here if that is more" gives the matching statistics: for each position the length of the
longest string from there that also starts elsewhere in the block. In a repetitive block the runs are
few, and so are the extensions.
"""

from __future__ import annotations

import numpy as np

#: Ranks take 21 bits, so that three fit a word.
MAX_BYTES = (1 << 21) - 2


class RunIndex:
    """``texts``: byte strings of ``MAX_BYTES`` in all at most, a separator after each included."""

    def __init__(self, texts: list[bytes]):
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths + 1)])
        self.n = n = int(self.starts[-1])
        if n > MAX_BYTES:
            raise ValueError("block too large")
        raw = np.frombuffer(b"\x00".join([*texts, b""]), np.uint8)
        used = np.zeros(256, bool)
        used[raw] = True
        stops = np.zeros(n, bool)
        stops[self.starts[1:] - 1] = True
        codes = np.zeros(256, np.uint16)
        codes[used] = np.arange(1, used.sum() + 1)
        self.text = codes[raw]
        self.text[stops] = 0
        bits = max(1, int(used.sum()).bit_length())
        first, key = 64 // bits, np.zeros(n, np.uint64)
        for k in range(first):
            key <<= np.uint64(bits)
            key[: max(0, n - k)] |= self.text[k:]
        #: (length, ranks of the strings of that length from each position on, 0 beyond the end)
        self.levels: list[tuple[int, np.ndarray]] = []
        size, longest = first, int(self.lengths.max(initial=0))
        order = np.argsort(key)
        sorted_key = key[order]
        new = np.ones(n, bool)
        new[1:] = sorted_key[1:] != sorted_key[:-1]
        while True:
            count = np.cumsum(new, dtype=np.int32)
            rank = np.empty(n, np.int32)
            rank[order] = count
            self.levels.append((size, rank))
            if size > longest or count[-1] == n:
                break
            # only suffixes that others are equal to so far change places, and only among those
            tied = ~new
            tied[:-1] |= tied[1:]
            at = np.flatnonzero(tied)
            suffix = order[at]
            padded = np.zeros(n + 2 * size, np.int64)
            padded[:n] = rank
            key = (padded[suffix] << 42) | (padded[suffix + size] << 21) | padded[suffix + 2 * size]
            by_key = np.argsort(key)
            order[at] = suffix[by_key]
            key = key[by_key]
            new[at[1:]] = key[1:] != key[:-1]
            size *= 3
        self.suffixes = order
        # rows of the transform that begin a run; the start of a text is a run by itself
        before = np.where(order > 0, self.text[order - 1], 0)
        begins = np.ones(n, bool)
        begins[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
        self.begins = np.flatnonzero(begins)
        self.ends_at = np.repeat((self.starts[1:] - 1).astype(np.int32), self.lengths + 1)

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The length of the longest common extension of the suffixes at ``i`` and ``j``, inside their texts."""
        got, most = np.zeros(len(i), np.int64), np.minimum(self.ends_at[i] - i, self.ends_at[j] - j)
        for k, (size, rank) in reversed(list(enumerate([(1, self.text), *self.levels]))):
            top = k == len(self.levels)
            live = np.flatnonzero(got < most)
            for _ in range(1 << 30 if top else max(2, self.levels[0][0] - 1) if k == 0 else 2):
                live = live[got[live] < most[live]]
                if not len(live):
                    break
                a, b = i[live] + got[live], j[live] + got[live]
                live = live[rank[a] == rank[b]]
                if not len(live):
                    break
                got[live] += size
        return np.minimum(got, most)

    def matching_statistics(self) -> np.ndarray:
        """Per position, the length of the longest string from there, inside its text, that also starts elsewhere."""
        b = self.begins[self.begins > 0]
        i, j = self.suffixes[b - 1], self.suffixes[b]
        length = self.extension(i, j)
        reach = np.zeros(self.n, np.int64)
        np.maximum.at(reach, i, i + length)
        np.maximum.at(reach, j, j + length)
        return np.maximum(np.maximum.accumulate(reach) - np.arange(self.n), 0)

    def repeats(self, least: int) -> list[list[tuple[int, int]]]:
        """Per text, the maximal spans covered by strings of ``least`` bytes that occur twice or more in the block."""
        ms, at = self.matching_statistics(), np.arange(self.n)
        covered = np.maximum.accumulate(np.where(ms >= least, at + ms, 0)) > at
        edge = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
        begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        out: list[list[tuple[int, int]]] = [[] for _ in self.lengths]
        owner = np.searchsorted(self.starts, begins, side="right") - 1
        for k, s, e in zip(owner.tolist(), begins.tolist(), ends.tolist()):
            base = int(self.starts[k])
            out[k].append((s - base, e - base))
        return out
