"""Range asymmetric numeral system over token ids, with numpy across interleaved lanes.

A block is a run of ids. Id ``i`` belongs to lane ``i % LANES``; all lanes of all blocks of a call step
together. States are 64-bit and give 32-bit words. Every ``CHECKPOINT_STEPS`` steps the encoder keeps its
states and its place in the words, so that a decoder can start there."""

from __future__ import annotations

import numpy as np

SCALE_BITS = 20
LANES = 64
CHECKPOINT_STEPS = 512
LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_SCALE = np.uint64(SCALE_BITS)
_MASK = np.uint64((1 << SCALE_BITS) - 1)


class Table:
    """Shared frequencies, scaled to sum up to 2 ** SCALE_BITS; every id that occurs has one at least."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))
        if len(self.symbol) != 1 << SCALE_BITS:
            raise ValueError("frequencies don't sum up to the scale")

    @classmethod
    def from_counts(cls, counts: np.ndarray) -> Table:
        counts = counts.astype(np.float64)
        n_used = int((counts > 0).sum())
        if n_used == 0:
            counts = np.ones(1)
            n_used = 1
        if n_used > 1 << SCALE_BITS:
            raise ValueError("more distinct ids than the scale has places")
        room = (1 << SCALE_BITS) - n_used
        share = counts / counts.sum() * room
        freq = np.floor(share).astype(np.int64) + (counts > 0)
        # What rounding left goes to the largest remainders, by id where they tie.
        left = (1 << SCALE_BITS) - int(freq.sum())
        order = np.lexsort((np.arange(len(counts)), -(share - np.floor(share)) * (counts > 0), counts == 0))
        freq[order[:left]] += 1
        return cls(freq)


def _steps(n: np.ndarray) -> np.ndarray:
    return -(-n // LANES)


def encode(blocks: list[np.ndarray], table: Table) -> list[tuple[bytes, bytes, bytes]]:
    """For each block: its words, and per checkpoint the states of all lanes and the place in the words."""
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    steps = _steps(np.array([len(blocks[i]) for i in order], np.int64))
    n, most = len(order), int(steps.max(initial=0))
    filler = np.uint32(np.argmax(table.freq))
    ids = np.full((most, n, LANES), filler, np.uint32)
    for k, i in enumerate(order):
        own = np.full(int(steps[k]) * LANES, filler, np.uint32)
        own[: len(blocks[i])] = blocks[i]
        ids[: steps[k], k] = own.reshape(-1, LANES)
    states = np.full((n, LANES), LOW, np.uint64)
    words = np.zeros((most, n, LANES), np.uint32)
    sent = np.zeros((most, n, LANES), bool)
    marks = np.zeros((-(-most // CHECKPOINT_STEPS), n, LANES), np.uint64)
    active = np.searchsorted(-steps, -np.arange(most), side="left")  # blocks with more than so many steps
    limit_shift = np.uint64(31 - SCALE_BITS + 32)
    for step in range(most - 1, -1, -1):
        a = active[step]
        x, s = states[:a], ids[step, :a]
        freq = table.freq[s]
        full = x >= freq << limit_shift
        sent[step, :a] = full
        words[step, :a] = x.astype(np.uint32)
        x = np.where(full, x >> _WORD, x)
        q = x // freq
        states[:a] = (q << _SCALE) + (x - q * freq) + table.start[s]
        if step % CHECKPOINT_STEPS == 0:
            marks[step // CHECKPOINT_STEPS, :a] = states[:a]
    found: list = [None] * n
    for k, i in enumerate(order):
        own, t = sent[: steps[k], k], int(steps[k])
        places = np.concatenate([[0], np.cumsum(own.sum(axis=1))])[0:t:CHECKPOINT_STEPS]
        n_marks = len(places)
        found[i] = (words[:t, k][own].astype("<u4").tobytes(), marks[:n_marks, k].astype("<u8").tobytes(), places.astype("<i8").tobytes())
    return found


def decode(blocks: list[tuple[bytes, bytes, bytes, int]], table: Table) -> list[np.ndarray]:
    """The ids of blocks of (words, states, places, number of ids). Every stretch between two
    checkpoints is decoded on its own, all of them side by side."""
    parts = []
    for k, (words, states, places, n) in enumerate(blocks):
        w = np.frombuffer(words, "<u4")
        x = np.frombuffer(states, "<u8").reshape(-1, LANES)
        p = np.frombuffer(places, "<i8")
        t = int(_steps(np.array([n]))[0])
        for j in range(len(p)):
            end = p[j + 1] if j + 1 < len(p) else len(w)
            parts.append((k, j, min(CHECKPOINT_STEPS, t - j * CHECKPOINT_STEPS), w[p[j] : end], x[j]))
    parts.sort(key=lambda part: -part[2])
    steps = np.array([part[2] for part in parts], np.int64)
    n, most = len(parts), int(steps.max(initial=0))
    base = np.cumsum([0] + [len(part[3]) + LANES for part in parts])
    words = np.zeros(base[-1], np.uint64)
    for at, part in zip(base, parts, strict=False):
        words[at : at + len(part[3])] = part[3]
    at = base[:-1].copy()
    states = np.array([part[4] for part in parts], np.uint64).reshape(n, LANES)
    ids = np.zeros((n, most, LANES), np.uint32)
    active = np.searchsorted(-steps, -np.arange(most), side="left")
    for step in range(most):
        a = active[step]
        x = states[:a]
        slot = x & _MASK
        s = table.symbol[slot]
        ids[:a, step] = s
        x = table.freq[s] * (x >> _SCALE) + slot - table.start[s]
        low = x < LOW
        rank = np.cumsum(low, axis=1)
        word = words[at[:a, None] + np.maximum(rank - 1, 0)]
        states[:a] = np.where(low, (x << _WORD) | word, x)
        at[:a] += rank[:, -1]
    found = [np.empty(int(_steps(np.array([b[3]]))[0]) * LANES, np.uint32) for b in blocks]
    for r, (k, j, t, _, _) in enumerate(parts):
        found[k][j * CHECKPOINT_STEPS * LANES : (j * CHECKPOINT_STEPS + t) * LANES] = ids[r, :t].ravel()
    return [f[: b[3]] for f, b in zip(found, blocks, strict=True)]
