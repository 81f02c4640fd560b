"""Canonical, length-limited Huffman codes of integers: code lengths, packing and table decoding."""

from __future__ import annotations

import numpy as np

#: Symbols between two places at which decoding can start.
CHECKPOINT = 128
#: Longest code; the decoding table has 2 ** LIMIT entries.
LIMIT = 18


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code with no code above ``limit`` bits (package-merge).

    ``counts`` holds one positive count per symbol. A lone symbol gets one bit.
    """
    n = len(counts)
    if n < 2:
        return np.ones(n, dtype=np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols need codes above {limit} bits")
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.float64)
    merged, leaf_flags = weights, [np.ones(n, dtype=bool)]
    for _ in range(limit - 1):
        even = len(merged) // 2 * 2
        packages = merged[:even:2] + merged[1:even:2]
        both = np.concatenate((weights, packages))
        place = np.argsort(both, kind="stable")
        merged = both[place]
        leaf_flags.append(place < n)
    lengths = np.zeros(n, dtype=np.int64)
    take = 2 * n - 2
    for flags in reversed(leaf_flags):
        leaves = int(flags[:take].sum())
        lengths[:leaves] += 1
        take = 2 * (take - leaves)
    result = np.empty(n, dtype=np.int64)
    result[order] = lengths
    return result


class Code:
    """The canonical code that ``symbols`` and ``lengths`` stand for: shorter codes first, then
    smaller symbols. Nothing else has to be stored."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray) -> None:
        order = np.lexsort((symbols, lengths))
        self.symbols, self.lengths = symbols[order], lengths[order]
        self.limit = int(self.lengths[-1]) if len(order) else 1
        steps = np.left_shift(1, self.limit - self.lengths)
        starts = np.cumsum(steps) - steps  # codes, filled up to the longest with zeros
        top = int(self.symbols.max(initial=0)) + 1
        self._code = np.zeros(top, dtype=np.uint64)
        self._length = np.zeros(top, dtype=np.int64)
        self._code[self.symbols] = (starts >> (self.limit - self.lengths)).astype(np.uint64)
        self._length[self.symbols] = self.lengths
        # Decoding: the next ``limit`` bits name symbol and length at once.
        self._table = np.repeat(
            (self.symbols.astype(np.int64) << 8) | self.lengths, steps if len(order) else 0
        )

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bits of ``ids`` (in 32-bit big-endian words) and the bit offset of every
        ``CHECKPOINT``-th id."""
        lengths = self._length[ids]
        ends = np.cumsum(lengths)
        starts = ends - lengths
        total = int(ends[-1]) if len(ends) else 0
        words = total // 32 + 1
        word = starts >> 5
        shift = (64 - lengths - (starts & 31)).astype(np.uint64)
        value = self._code[ids] << shift
        high = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), words + 1)
        low = np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), words + 1)
        bits = (high + low).astype(np.uint64).astype(">u4").tobytes()
        return bits, starts[::CHECKPOINT].astype(np.int64)

    def decode(self, blocks: list[tuple[bytes, np.ndarray, int]]) -> list[np.ndarray]:
        """Ids of blocks (bits, checkpoints, number of ids), all checkpoints' runs side by side.
        No blocks give no ids."""
        stream = np.frombuffer(b"".join(x[0] for x in blocks) + bytes(12), dtype=">u4")
        stream = stream.astype(np.uint64)
        pairs = (stream[:-1] << np.uint64(32)) | stream[1:]
        base = np.cumsum([0, *(len(x[0]) * 8 for x in blocks)], dtype=np.int64)
        at = np.concatenate([np.empty(0, np.int64), *(b + x[1] for b, x in zip(base, blocks))])
        lanes = np.array([-(-x[2] // CHECKPOINT) for x in blocks], dtype=np.int64)
        if [len(x[1]) for x in blocks] != lanes.tolist():
            raise ValueError("checkpoints do not fit the number of ids")
        counts = np.array([x[2] for x in blocks], dtype=np.int64)
        out = np.zeros((len(at), CHECKPOINT), dtype=np.uint32)
        left = np.full(len(at), CHECKPOINT)
        last = np.cumsum(lanes)
        some = counts > 0
        left[last[some] - 1] = (counts[some] - 1) % CHECKPOINT + 1
        order = np.argsort(-left, kind="stable")  # short runs are at the end of their block
        at, left = at[order], left[order]
        found = np.zeros((CHECKPOINT, len(at)), dtype=np.uint32)
        drop = np.uint64(64 - self.limit)
        for step in range(CHECKPOINT):
            live = int(np.searchsorted(-left, -step, side="left"))
            if not live:
                break
            here = at[:live]
            window = (pairs[here >> 5] << (here & 31).astype(np.uint64)) >> drop
            entry = self._table[window.astype(np.int64)]
            found[step, :live] = entry >> 8
            here += entry & 255
        out[order] = found.T
        ends = np.cumsum(lanes)
        flat = [out[e - n : e].ravel() for e, n in zip(ends, lanes, strict=True)]
        return [x[:n] for x, n in zip(flat, counts, strict=True)]
