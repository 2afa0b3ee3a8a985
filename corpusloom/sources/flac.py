"""A FLAC encoder for 16-bit samples: fixed predictors and Rice codes, a block at a time in NumPy."""

from __future__ import annotations

import hashlib
import struct

import numpy as np

BLOCK = 4096


def _crc_table(poly: int, width: int) -> list[int]:
    top, mask, out = 1 << (width - 1), (1 << width) - 1, []
    for b in range(256):
        c = b << (width - 8)
        for _ in range(8):
            c = (c << 1) ^ poly if c & top else c << 1
        out.append(c & mask)
    return out


CRC8, CRC16 = _crc_table(0x07, 8), _crc_table(0x8005, 16)


def crc8(data: bytes) -> int:
    c = 0
    for b in data:
        c = CRC8[c ^ b]
    return c


def crc16(data: bytes) -> int:
    c = 0
    for b in data:
        c = (c << 8 & 0xFFFF) ^ CRC16[c >> 8 ^ b]
    return c


def _bits(values, width: int) -> np.ndarray:
    """The low ``width`` bits of each value, the highest first."""
    v = np.asarray(values, np.int64).reshape(-1, 1)
    return ((v >> np.arange(width - 1, -1, -1)) & 1).astype(np.uint8).reshape(-1)


def _rice(u: np.ndarray, k: int) -> np.ndarray:
    q = u >> k
    ends = np.cumsum(q + 1 + k)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    one = ends - k - 1
    out[one] = 1
    for i in range(k):
        out[one + 1 + i] = (u >> (k - 1 - i)) & 1
    return out


def _subframe(x: np.ndarray) -> np.ndarray:
    """One channel of a block: constant, or the fixed predictor and Rice parameter of fewest bits, or verbatim."""
    if (x == x[0]).all():
        return np.concatenate([_bits([0], 8), _bits(x[:1], 16)])
    best, cost = None, 16 * len(x)
    for order in range(min(5, len(x))):
        r = np.diff(x, n=order)
        u = np.where(r < 0, -2 * r - 1, 2 * r)
        for k in range(15):
            n = 16 * order + 10 + int((u >> k).sum()) + len(u) * (1 + k)
            if n < cost:
                best, cost = (order, k, u), n
    if best is None:
        return np.concatenate([_bits([2], 8), _bits(x, 16)])
    order, k, u = best
    return np.concatenate([_bits([(8 | order) << 1], 8), _bits(x[:order], 16), _bits([0], 6), _bits([k], 4), _rice(u, k)])


def _number(n: int) -> bytes:
    """A frame number in the manner of UTF-8, up to 31 bits."""
    if n < 0x80:
        return bytes([n])
    tail = []
    size = 2
    while n >> (5 * size + 1):
        size += 1
    for _ in range(size - 1):
        tail.append(0x80 | n & 0x3F)
        n >>= 6
    return bytes([0xFF00 >> size & 0xFF | n, *tail[::-1]])


def encode_flac(samples: np.ndarray, rate: int) -> bytes:
    """A FLAC stream of whole numbers within 16 bits, of shape (frames, channels), 1 to 8 channels."""
    x = np.asarray(samples)
    n, channels = x.shape
    if not 1 <= channels <= 8 or not 0 < rate < 1 << 20 or x.dtype != np.int16:
        raise ValueError("16-bit samples of 1 to 8 channels at a rate below 2**20 are encoded")
    info = struct.pack(">HHHHHH", BLOCK, BLOCK, 0, 0, 0, 0)[:10] + (rate << 44 | (channels - 1) << 41 | 15 << 36 | n).to_bytes(8, "big")
    out = [b"fLaC", b"\x80\x00\x00\x22", info, hashlib.md5(x.astype("<i2").tobytes()).digest()]
    for k in range(0, n, BLOCK):
        part = x[k : k + BLOCK].astype(np.int64)
        head = b"\xff\xf8" + bytes([0x70, (channels - 1) << 4 | 8]) + _number(k // BLOCK) + struct.pack(">H", len(part) - 1)
        head += bytes([crc8(head)])
        frame = head + np.packbits(np.concatenate([_subframe(part[:, c]) for c in range(channels)])).tobytes()
        out += (frame, struct.pack(">H", crc16(frame)))
    return b"".join(out)
