"""Monotone integer sequences in Elias-Fano form, in blocks.

Each block of ``BLOCK`` values keeps its first value, the low bits of the
distances to it packed side by side, and the high bits as a unary bit vector:
about two bits plus log2(range / values) a value.  Blocks are decoded one at a
time, so a sequence can stay in a memory-mapped file.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1 << 13


def ef_encode(values: np.ndarray) -> bytes:
    """``values`` ascending (repeats allowed), unsigned 64 bits."""
    values = np.asarray(values, dtype=np.uint64)
    firsts, offsets, widths, body, size = [], [0], [], [], 0
    for i in range(0, len(values), BLOCK):
        part = values[i:i + BLOCK]
        gap = part - part[0]
        span = int(gap[-1]) // len(part)
        width = span.bit_length() - 1 if span > 0 else 0
        high = (gap >> np.uint64(width)).astype(np.int64)
        unary = np.zeros(int(high[-1]) + len(part), np.uint8)
        unary[high + np.arange(len(part))] = 1
        data = np.packbits(unary, bitorder="little").tobytes()
        if width:
            low = gap.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :(width + 7) // 8]
            bits = np.unpackbits(low, axis=1, bitorder="little")[:, :width]
            data = np.packbits(bits.ravel(), bitorder="little").tobytes() + data
        firsts.append(part[0])
        widths.append(width)
        body.append(data)
        size += len(data)
        offsets.append(size)
    head = np.array([len(values)], "<u8").tobytes() + np.array(firsts, "<u8").tobytes() \
        + np.array(offsets, "<u8").tobytes() + np.array(widths, "<u8").tobytes()
    return head + b"".join(body)


class EliasFano:
    """Reads what ``ef_encode`` wrote from a buffer of bytes (an array, which may
    be memory-mapped)."""

    def __init__(self, buffer: np.ndarray):
        self.n = int(buffer[:8].view("<u8")[0])
        blocks = -(-self.n // BLOCK)
        at = 8
        self.firsts = buffer[at:at + 8 * blocks].view("<u8")
        at += 8 * blocks
        self.offsets = buffer[at:at + 8 * (blocks + 1)].view("<u8").astype(np.int64)
        at += 8 * (blocks + 1)
        self.widths = buffer[at:at + 8 * blocks].view("<u8")
        self.body = buffer[at + 8 * blocks:]

    def __len__(self) -> int:
        return self.n

    def block(self, i: int) -> np.ndarray:
        m, width = min(BLOCK, self.n - i * BLOCK), int(self.widths[i])
        data = np.asarray(self.body[self.offsets[i]:self.offsets[i + 1]])
        cut = (m * width + 7) // 8
        high = (np.flatnonzero(np.unpackbits(data[cut:], bitorder="little")) - np.arange(m)).astype(np.uint64)
        out = high << np.uint64(width)
        if width:
            bits = np.unpackbits(data[:cut], bitorder="little")[:m * width].reshape(m, width)
            low = np.zeros((m, 8), np.uint8)
            low[:, :(width + 7) // 8] = np.packbits(bits, axis=1, bitorder="little")
            out |= low.view("<u8").ravel()
        return out + np.uint64(self.firsts[i])

    def values(self) -> np.ndarray:
        parts = [self.block(i) for i in range(len(self.firsts))]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint64)

    def get(self, index: np.ndarray) -> np.ndarray:
        """The values at ``index`` (ascending)."""
        out = np.zeros(len(index), np.uint64)
        owner = index // BLOCK
        edges = np.flatnonzero(np.diff(owner, prepend=-1))
        for a, b in zip(edges, [*edges[1:], len(index)]):
            i = int(owner[a])
            out[a:b] = self.block(i)[index[a:b] - i * BLOCK]
        return out

    def successor(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For ascending ``queries``: index of the first value not below each
        (the length if there is none) and that value (0 if none)."""
        queries = np.asarray(queries, dtype=np.uint64)
        index, found = np.full(len(queries), self.n, np.int64), np.zeros(len(queries), np.uint64)
        if not self.n or not len(queries):
            return index, found
        # The block whose first value is the last one below the query holds the
        # successor, or the next block's first value is it.
        owner = np.maximum(np.searchsorted(self.firsts, queries, "left") - 1, 0)
        edges = np.flatnonzero(np.diff(owner, prepend=-1))
        for a, b in zip(edges, [*edges[1:], len(queries)]):
            i = int(owner[a])
            block = self.block(i)
            at = np.searchsorted(block, queries[a:b], "left")
            inside = at < len(block)
            index[a:b] = i * BLOCK + at
            found[a:b][inside] = block[at[inside]]
            if not inside.all() and i + 1 < len(self.firsts):
                found[a:b][~inside] = self.firsts[i + 1]
        return index, found
