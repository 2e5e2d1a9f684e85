"""Token-id files of patched frame-of-reference blocks.

A shard holds the ids of a run of documents. Layout (little-endian):

    magic "TKPF", blocks, block starts (u64 each), documents, footer

A block holds up to BLOCK ids: their minimum, the width in bits that the
PERCENTILE-th difference to the minimum needs, all differences packed at that
width, and an exception list (position, whole difference) of those that need
more. A document is its id (or none), its first token within the shard and
its length. The footer says where the lists begin, so a block or a document
is found by its number without reading what stands before it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np

MAGIC = b"TKPF"
BLOCK = 128
PERCENTILE = 0.9
# Blocks coded at a time.
GROUP = 2048
HEAD = np.dtype([("low", "<u4"), ("width", "u1"), ("exceptions", "u1"), ("count", "<u2")])
PATCH = np.dtype([("at", "u1"), ("diff", "<u4")])
DOC = np.dtype([("id", "<i8"), ("has_id", "u1"), ("start", "<u8"), ("n", "<u8")])
FOOTER = struct.Struct("<QQQQ4s")


def _widths(x: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.frexp(x.astype(np.float64))[1]


def _pack(x: np.ndarray, w: int) -> np.ndarray:
    """Rows of BLOCK values at ``w`` bits each, lowest bit first, as bytes; lane by lane over all rows."""
    lanes = np.ascontiguousarray(x.T.astype(np.uint64)) & np.uint64((1 << w) - 1)
    out = np.zeros((BLOCK * w // 64, x.shape[0]), np.uint64)
    for j in range(BLOCK):
        word, shift = divmod(j * w, 64)
        out[word] |= lanes[j] << np.uint64(shift)
        if shift + w > 64:
            out[word + 1] |= lanes[j] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).astype("<u8").view(np.uint8)


def _unpack(b: np.ndarray, w: int) -> np.ndarray:
    words = np.ascontiguousarray(np.ascontiguousarray(b).view("<u8").T)
    out = np.empty((BLOCK, words.shape[1]), np.uint64)
    for j in range(BLOCK):
        word, shift = divmod(j * w, 64)
        out[j] = words[word] >> np.uint64(shift)
        if shift + w > 64:
            out[j] |= words[word + 1] << np.uint64(64 - shift)
    return (out & np.uint64((1 << w) - 1)).T.astype(np.int64)


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[bytes, np.ndarray]:
    """Coded blocks of ``ids`` (uint32), and the length in bytes of each."""
    if not len(ids):
        return b"", np.empty(0, np.int64)
    nb = -(-len(ids) // BLOCK)
    counts = np.full(nb, BLOCK)
    counts[-1] = len(ids) - BLOCK * (nb - 1)
    x = np.pad(ids.astype(np.int64), (0, nb * BLOCK - len(ids)), mode="edge").reshape(nb, BLOCK)
    low = x.min(1)
    diff = x - low[:, None]
    rank = min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)
    width = _widths(np.partition(diff, rank, axis=1)[:, rank]).astype(np.int64)
    patch = diff >> width[:, None] > 0
    patch &= np.arange(BLOCK) < counts[:, None]
    n = patch.sum(1)
    head = np.zeros(nb, HEAD)
    head["low"], head["width"], head["exceptions"], head["count"] = low, width, n, counts
    sizes = HEAD.itemsize + BLOCK // 8 * width + PATCH.itemsize * n
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    out[starts[:, None] + np.arange(HEAD.itemsize)] = head.view(np.uint8).reshape(-1, HEAD.itemsize)
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        out[starts[rows][:, None] + HEAD.itemsize + np.arange(BLOCK // 8 * w)] = _pack(diff[rows], w)
    row, at = np.nonzero(patch)
    p = np.zeros(len(row), PATCH)
    p["at"], p["diff"] = at, diff[row, at]
    place = np.arange(len(row)) - (np.cumsum(n) - n)[row]
    begin = starts[row] + HEAD.itemsize + BLOCK // 8 * width[row] + PATCH.itemsize * place
    out[begin[:, None] + np.arange(PATCH.itemsize)] = p.view(np.uint8).reshape(-1, PATCH.itemsize)
    return out.tobytes(), sizes


def decode_blocks(raw: bytes, starts: np.ndarray) -> np.ndarray:
    """Ids of the blocks that begin at ``starts`` in ``raw``."""
    if not len(starts):
        return np.empty(0, np.uint32)
    b = np.frombuffer(raw, np.uint8)
    head = b[starts[:, None] + np.arange(HEAD.itemsize)].copy().view(HEAD).ravel()
    out = np.zeros((len(starts), BLOCK), np.int64)
    width, n = head["width"].astype(np.int64), head["exceptions"].astype(np.int64)
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        out[rows] = _unpack(b[starts[rows][:, None] + HEAD.itemsize + np.arange(BLOCK // 8 * w)], w)
    row = np.repeat(np.arange(len(starts)), n)
    place = np.arange(len(row)) - (np.cumsum(n) - n)[row]
    begin = starts[row] + HEAD.itemsize + BLOCK // 8 * width[row] + PATCH.itemsize * place
    p = b[begin[:, None] + np.arange(PATCH.itemsize)].copy().view(PATCH).ravel()
    out[row, p["at"]] = p["diff"]
    out += head["low"].astype(np.int64)[:, None]
    return out[np.arange(BLOCK) < head["count"][:, None]].astype(np.uint32)


class ShardWriter:
    """Appends documents; holds one group of ids and the lists of starts."""

    def __init__(self, f: BinaryIO):
        self.f, self.at, self.tokens = f, len(MAGIC), 0
        self.pending: list[np.ndarray] = []
        self.held = 0
        self.sizes: list[np.ndarray] = []
        self.docs: list[tuple] = []
        f.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id or 0, doc_id is not None, self.tokens, len(ids)))
        self.tokens += len(ids)
        self.pending.append(ids)
        self.held += len(ids)
        if self.held >= GROUP * BLOCK:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate([np.empty(0, np.uint32), *self.pending])
        cut = len(ids) if last else len(ids) // BLOCK * BLOCK
        for k in range(0, cut, GROUP * BLOCK):
            raw, sizes = encode_blocks(ids[k:min(cut, k + GROUP * BLOCK)])
            self.f.write(raw)
            self.sizes.append(sizes)
        self.pending, self.held = [ids[cut:]], len(ids) - cut

    def close(self) -> None:
        self._flush(True)
        sizes = np.concatenate([np.empty(0, np.int64), *self.sizes])
        starts = (len(MAGIC) + np.cumsum(sizes) - sizes).astype("<u8")
        end = int(len(MAGIC) + sizes.sum())
        self.f.write(starts.tobytes())
        self.f.write(np.array(self.docs, DOC).tobytes())
        self.f.write(FOOTER.pack(end, len(starts), len(self.docs), self.tokens, MAGIC))
        self.f.close()


class ShardReader:
    def __init__(self, f: BinaryIO):
        self.f = f
        size = f.seek(0, 2)
        f.seek(size - FOOTER.size)
        self.end, blocks, docs, self.tokens, magic = FOOTER.unpack(f.read(FOOTER.size))
        f.seek(0)
        if magic != MAGIC or f.read(len(MAGIC)) != MAGIC:
            raise ValueError("not a token shard")
        if self.end + 8 * blocks + DOC.itemsize * docs + FOOTER.size != size:
            raise ValueError("the shard's length does not match its footer")
        f.seek(self.end)
        self.starts = np.frombuffer(f.read(8 * blocks), "<u8").astype(np.int64)
        self.docs = np.frombuffer(f.read(DOC.itemsize * docs), DOC)

    def ids(self, first: int, n: int) -> np.ndarray:
        """``n`` token ids from ``first`` on, through the block starts."""
        if not n:
            return np.empty(0, np.uint32)
        a, z = first // BLOCK, -(-(first + n) // BLOCK)
        stop = int(self.starts[z]) if z < len(self.starts) else self.end
        self.f.seek(int(self.starts[a]))
        raw = self.f.read(stop - int(self.starts[a]))
        return decode_blocks(raw, self.starts[a:z] - self.starts[a])[first - a * BLOCK:][:n]

    def crcs(self) -> Iterator[int]:
        """Unsigned crc32 of each document's ids as little-endian u32, reading groups of blocks."""
        at, buf = 0, b""  # token at which buf begins
        for d in self.docs:
            first, left, crc = int(d["start"]), int(d["n"]), 0
            while left:
                skip = 4 * (first - at)
                if skip >= len(buf):
                    # a group always begins at a whole block
                    at = first // (GROUP * BLOCK) * (GROUP * BLOCK)
                    buf = self.ids(at, min(GROUP * BLOCK, self.tokens - at)).astype("<u4").tobytes()
                    skip = 4 * (first - at)
                part = buf[skip:skip + 4 * left]
                crc = zlib.crc32(part, crc)
                first, left = first + len(part) // 4, left - len(part) // 4
            yield crc
