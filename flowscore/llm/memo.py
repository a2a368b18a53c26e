"""A memo of short strings and their token ids in arrays of fixed size, looked up for many strings at once."""

from __future__ import annotations

import numpy as np

#: Bytes of a string and ids that fit in.
KEY_BYTES, KEY_IDS = 31, 12
#: Places of a row; a string's hash gives its row, and the oldest of a full row goes.
WAYS = 4
_PARTS = (KEY_BYTES + 1) // 8
# The first n bytes of a little-endian number.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


def spread(firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each first one on, so many as its size, one after another."""
    ends = np.cumsum(sizes, dtype=firsts.dtype)
    return np.repeat(firsts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0, dtype=firsts.dtype)


def keys_of(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The strings' bytes with their length as four numbers each (equal only for equal strings of at most ``KEY_BYTES``
    bytes), and a hash of them that is never 0.  ``data`` goes on for ``KEY_BYTES`` + 1 bytes after the last one."""
    at_any_byte = np.ndarray((max(len(data) - 7, 0),), "<u8", data, 0, (1,))
    keys, hashes = np.zeros((_PARTS, len(starts)), dtype=np.uint64), np.zeros(len(starts), dtype=np.uint64)
    for part, key in enumerate(keys):
        left = np.flatnonzero(sizes > 8 * part) if part else slice(None)
        key[left] = at_any_byte[starts[left] + 8 * part] & _FIRST[np.minimum(sizes[left] - 8 * part, 8)]
    keys[-1] |= np.minimum(sizes, 255).astype(np.uint64) << np.uint64(56)
    for key, mix in zip(keys, _MIX, strict=True):
        hashes ^= key * mix
    for mix in _MIX[:2]:
        hashes ^= hashes >> np.uint64(32)
        hashes *= mix
    hashes ^= hashes >> np.uint64(32)
    return keys.T, hashes | np.uint64(1)


class Memo:
    """At most a few more than ``size`` strings and the ids of each."""

    def __init__(self, size: int, kind: np.dtype):
        rows = 1 << max(size // WAYS, 1).bit_length()
        self._rows, self._count = np.uint64(rows - 1), 0
        self._hashes = np.zeros((rows, WAYS), dtype=np.uint64)
        self._next = np.zeros(rows, dtype=np.int8)
        self._keys = np.zeros((rows * WAYS, _PARTS), dtype=np.uint64)
        self._ids = np.zeros((rows * WAYS, KEY_IDS), dtype=kind)
        self._sizes = np.zeros(rows * WAYS, dtype=np.uint8)

    def __len__(self) -> int:
        return self._count

    def __contains__(self, text: str) -> bool:
        raw = text.encode()
        keys, hashes = keys_of(np.frombuffer(raw + bytes(KEY_BYTES + 1), dtype=np.uint8), np.zeros(1, np.int64),
                               np.array([len(raw)]))
        return len(raw) <= KEY_BYTES and bool(self.find(keys, hashes)[0] >= 0)

    def _row(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(1) & self._rows).astype(np.int64)

    def find(self, keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The place of each string, -1 if it is not kept."""
        rows = self._row(hashes)
        same = self._hashes[rows] == hashes[:, None]
        at = same.argmax(1)
        hit = np.flatnonzero(same[np.arange(len(at)), at])
        places = np.full(len(hashes), -1, dtype=np.int64)
        here = rows[hit] * WAYS + at[hit]
        places[hit] = np.where((self._keys[here] == keys[hit]).all(1), here, -1)
        return places

    def sizes(self, places: np.ndarray) -> np.ndarray:
        return self._sizes[places].astype(np.int32)

    def ids(self, places: np.ndarray) -> np.ndarray:
        """The ids of these places one after another."""
        return self._ids.reshape(-1)[spread(places * KEY_IDS, self.sizes(places))]

    def put(self, keys: np.ndarray, hashes: np.ndarray, sizes: np.ndarray, flat: np.ndarray) -> None:
        """Keep distinct strings that are not kept, of 1 to ``KEY_IDS`` ids each, which come one after another."""
        rows = self._row(hashes)
        order = np.argsort(rows, kind="stable")
        rows = rows[order]
        first, last = np.searchsorted(rows, rows), np.searchsorted(rows, rows, side="right")
        ways = (self._next[rows] + np.arange(len(rows)) - first) % WAYS
        self._next[rows] = (self._next[rows] + last - first) % WAYS
        stay = last - np.arange(len(rows)) <= WAYS
        order, places = order[stay], rows[stay] * WAYS + ways[stay]
        self._count += int(np.count_nonzero(self._sizes[places] == 0))
        to = spread(places * KEY_IDS, sizes[order])
        self._ids.reshape(-1)[to] = flat[spread((np.cumsum(sizes) - sizes)[order], sizes[order])]
        self._sizes[places] = sizes[order]
        self._keys[places], self._hashes.reshape(-1)[places] = keys[order], hashes[order]
