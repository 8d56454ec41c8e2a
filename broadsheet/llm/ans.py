"""A static range asymmetric numeral system over token ids, for NumPy.

Blocks of BLOCK ids are coded independently of each other with one shared frequency table. In a block, id t belongs to
lane t mod LANES, and the lanes are interleaved in one stream of 32-bit words. The decoder needs no more than the table,
the words and a checkpoint (the lanes' states and the place in the words); a block holds one at its start and one every
CHECKPOINT ids, so several readers can decode one block. All blocks of a segment are coded side by side.
"""

from __future__ import annotations

import zlib

import numpy as np

LANES = 64
BLOCK = 65_536
CHECKPOINT = 32_768
SCALE = 20  # frequencies add up to 1 << SCALE
LOW = np.uint64(1 << 31)  # states stay in LOW .. LOW << 32
_32, _SCALE, _MASK = np.uint64(32), np.uint64(SCALE), np.uint64((1 << SCALE) - 1)


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbols that occur, their shares of 1 << SCALE), each share at least 1."""
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts).astype(ids.dtype)
    counts, total = counts[symbols], 1 << SCALE
    if len(symbols) > total // 2:
        raise ValueError("too many different ids for the table")
    share = np.maximum(1, np.floor(counts * (total / counts.sum()))).astype(np.int64)
    over = int(share.sum()) - total
    if over < 0:
        share[np.argmax(counts)] -= over
    while over > 0:  # taken from the commonest, which lose least
        room = np.where(share > 1, share // 2, 0)
        for k in np.argsort(-room, kind="stable"):
            cut = min(over, int(room[k]))
            share[k] -= cut
            over -= cut
            if not over:
                break
    return symbols, share


def _starts(share: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(share)))[:-1]


def _encode_equal(ranks: np.ndarray, share: np.ndarray) -> list[tuple[bytes, list[tuple[int, np.ndarray]]]]:
    """Blocks of one length (rows of `ranks`, a multiple of LANES) to (words, checkpoints)."""
    blocks, n = ranks.shape
    steps = n // LANES
    lanes = ranks.reshape(blocks, steps, LANES).transpose(1, 0, 2).reshape(steps, blocks * LANES)
    freq, start = share.astype(np.uint64)[lanes], _starts(share).astype(np.uint64)[lanes]
    most = freq << np.uint64(63 - SCALE)  # a state from here on would outgrow LOW << 32
    state = np.full(blocks * LANES, LOW, np.uint64)
    out = np.empty((steps, blocks * LANES), np.uint32)
    sent = np.zeros((steps, blocks * LANES), bool)
    every = CHECKPOINT // LANES
    saved: dict[int, np.ndarray] = {}
    for s in range(steps - 1, -1, -1):
        f = freq[s]
        full = state >= most[s]
        sent[s] = full
        out[s] = state.astype(np.uint32)
        state = state >> (full * _32)
        q = state // f
        state = (q << _SCALE) + (state - q * f) + start[s]
        if s % every == 0:
            saved[s] = state
    result = []
    for b in range(blocks):
        cols = slice(b * LANES, (b + 1) * LANES)
        mask = sent[:, cols]
        before = np.concatenate(([0], np.cumsum(mask.sum(axis=1))))
        result.append((out[:, cols][mask].astype("<u4").tobytes(), [(int(before[s]), saved[s][cols]) for s in sorted(saved)]))
    return result


def encode(ids: np.ndarray, symbols: np.ndarray, share: np.ndarray) -> list[dict]:
    """Blocks {n, words, checkpoints, crc} of the ids (at least one), which must all be among the symbols."""
    rank_of = np.zeros(int(symbols[-1]) + 1, np.int32)
    rank_of[symbols] = np.arange(len(symbols))
    ranks = rank_of[ids]
    whole = len(ids) // BLOCK
    parts = _encode_equal(ranks[: whole * BLOCK].reshape(whole, BLOCK), share) if whole else []
    if rest := len(ids) - whole * BLOCK:
        padded = np.zeros(-(-rest // LANES) * LANES, ranks.dtype)
        padded[:rest] = ranks[whole * BLOCK:]
        parts += _encode_equal(padded[None, :], share)
    sizes = [BLOCK] * whole + [rest] * bool(rest)
    return [{"n": n, "words": w, "checkpoints": c, "crc": zlib.crc32(w)} for n, (w, c) in zip(sizes, parts)]


def decode(blocks: list[dict], symbols: np.ndarray, share: np.ndarray) -> np.ndarray:
    """The ids of consecutive blocks; every checkpoint's piece of every block is decoded side by side. A block whose words
    do not fit their checksum raises ValueError."""
    for k, block in enumerate(blocks):
        if zlib.crc32(block["words"]) != block["crc"]:
            raise ValueError(f"block {k} is damaged")
    if not blocks:
        return symbols[:0]
    pieces, words, at = [], [], 0
    for block in blocks:
        for k, (offset, states) in enumerate(block["checkpoints"]):
            pieces.append((min(CHECKPOINT, block["n"] - k * CHECKPOINT), at + offset, states))
        words.append(np.frombuffer(block["words"], "<u4"))
        at += len(words[-1])
    stream = np.append(np.concatenate(words), np.zeros(1, "<u4")).astype(np.uint64)
    rank_of = np.repeat(np.arange(len(symbols), dtype=np.int32), share)
    freq, start = share.astype(np.uint64), _starts(share).astype(np.uint64)
    ranks: list[np.ndarray] = [None] * len(pieces)
    for n in {p[0] for p in pieces}:
        mine = [k for k, p in enumerate(pieces) if p[0] == n]
        state = np.stack([pieces[k][2] for k in mine])
        here = np.array([pieces[k][1] for k in mine])
        steps = -(-n // LANES)
        out = np.empty((steps, len(mine), LANES), np.int32)
        for s in range(steps):
            slot = state & _MASK
            r = rank_of[slot]
            out[s] = r
            state = freq[r] * (state >> _SCALE) + slot - start[r]
            low = state < LOW
            place = np.cumsum(low, axis=1)
            word = stream[np.where(low, here[:, None] + place - 1, len(stream) - 1)]
            state = np.where(low, (state << _32) | word, state)
            here = here + place[:, -1]
        for k, got in zip(mine, out.transpose(1, 0, 2).reshape(len(mine), steps * LANES)):
            ranks[k] = got[:n]
    return symbols[np.concatenate(ranks)]
