"""Cuckoo filter on numpy arrays: 4 slots a bucket, 16-bit fingerprints.

A filter is a ``(buckets, 4)`` uint16 array, buckets a power of two, 0 an
empty slot.  A key's two buckets are ``i`` and ``i ^ hash(fingerprint)``, so a
stored fingerprint can move between them without the key.  All operations
take whole key arrays.
"""

from __future__ import annotations

import numpy as np

from vaultline.llm.common import mix64

SLOTS = 4
LOAD = 0.85  # above this share of the slots a filter counts as full
_ROUNDS = 500


def _places(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    fp = (keys & np.uint64(0xFFFF)).astype(np.uint16)
    fp[fp == 0] = 1
    at = ((keys >> np.uint64(16)) & np.uint64(buckets - 1)).astype(np.int64)
    return fp, at


def _other(fp: np.ndarray, at: np.ndarray, buckets: int) -> np.ndarray:
    return at ^ (mix64(fp.astype(np.uint64)) & np.uint64(buckets - 1)).astype(np.int64)


def size_for(n: int) -> int:
    """Buckets (a power of two) that hold ``n`` keys at half load or less."""
    need = max(1, int(n / (SLOTS * 0.5)))
    return 1 << (need - 1).bit_length()


def _settle(table: np.ndarray, fp: np.ndarray, at: np.ndarray, rng) -> bool:
    """Place all fingerprints, moving others to their second bucket."""
    buckets = len(table)
    for turn in range(_ROUNDS):
        if not len(fp):
            return True
        order = np.argsort(at, kind="stable")
        fp, at = fp[order], at[order]
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        rank = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
        free = table[at] == 0
        # The rank-th free slot of the bucket, where there is one.
        seen = np.cumsum(free, axis=1)
        fits = seen[:, -1] > rank
        slot = np.argmax(seen > rank[:, None], axis=1)
        table[at[fits], slot[fits]] = fp[fits]
        fp, at = fp[~fits], at[~fits]
        if not len(fp):
            return True
        if turn % 2 == 0:  # try the second bucket before moving anything
            at = _other(fp, at, buckets)
            continue
        # One key per bucket takes a random slot; its old content moves on.
        _, lead = np.unique(at, return_index=True)
        rest = np.ones(len(at), dtype=bool)
        rest[lead] = False
        slot = rng.integers(0, SLOTS, len(lead))
        out = table[at[lead], slot].copy()
        table[at[lead], slot] = fp[lead]
        moved_at = _other(out, at[lead], buckets)
        fp = np.r_[fp[rest], out]
        at = np.r_[at[rest], moved_at]
    return not len(fp)


def insert(table: np.ndarray | None, keys: np.ndarray, total: int) -> np.ndarray | None:
    """The filter with ``keys`` added; ``None`` if a stored filter has no room
    (it must then be rebuilt from its keys)."""
    fresh = table is None
    if fresh:
        table = np.zeros((size_for(total), SLOTS), np.uint16)
    elif total > LOAD * table.size:
        return None
    while True:
        work = table.copy()
        fp, at = _places(keys, len(work))
        if _settle(work, fp, at, np.random.default_rng(len(keys))):
            return work
        if not fresh:
            return None
        table = np.zeros((2 * len(table), SLOTS), np.uint16)


def contains(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    fp, at = _places(keys, len(table))
    return (table[at] == fp[:, None]).any(axis=1) | (table[_other(fp, at, len(table))] == fp[:, None]).any(axis=1)


def remove(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The filter with one stored fingerprint per key cleared."""
    table = table.copy()
    cells = table.reshape(-1)
    fp, at = _places(keys, len(table))
    left = np.arange(len(fp))
    for where in (at, _other(fp, at, len(table))):
        while len(left):
            same = table[where[left]] == fp[left][:, None]
            cell = where[left] * SLOTS + same.argmax(axis=1)
            found = np.flatnonzero(same.any(axis=1))
            _, first = np.unique(cell[found], return_index=True)
            if not len(first):
                break
            cells[cell[found[first]]] = 0  # each slot clears one key
            left = np.delete(left, found[first])
    return table


def dump(table: np.ndarray) -> bytes:
    return table.tobytes()


def load(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint16).reshape(-1, SLOTS)
