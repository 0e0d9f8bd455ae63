"""Vectorised work on Arrow text columns: units (words), 64-bit hashes, and exact lookups of distinct units.

All of it reads the UTF-8 bytes of a whole Arrow column in place, in blocks
of bounded size, so memory does not follow the length of a batch.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 2 << 20
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None  # of glibc alone
_TABLED = 4096
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _rng.integers(1, 2**63, _TABLED, dtype=np.uint64) | np.uint64(1)  # weights of the first places of a unit
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
#: White space of Unicode beyond ASCII, the bytes of each character as one number.
_WIDE_WHITE = np.array([int.from_bytes(chr(c).encode()) for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n+1 offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    bufs = column.buffers()
    offsets = np.frombuffer(bufs[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def weights(place: np.ndarray) -> np.ndarray:
    """An odd weight for each place of a unit, however long the unit is."""
    if not len(place) or place.max() < _TABLED:
        return _PLACE[place]
    far = place >= _TABLED
    out = _PLACE[np.where(far, 0, place)]
    out[far] = mix(place[far].astype(np.uint64) ^ np.uint64(0x5DEECE66D1B4F0A3)) | np.uint64(1)
    return out


def blocks(data: np.ndarray, offsets: np.ndarray, cut: Callable[[np.ndarray], np.ndarray], size: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, starts of the pieces in them, row of each piece), at most about ``size`` bytes at once.

    A row of more than ``size`` bytes is cut where ``cut(bytes)`` allows;
    where nothing allows a cut, the piece grows until one does.
    """
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        if offsets[j] - offsets[i] <= size:
            yield data[offsets[i] : offsets[j]], offsets[i:j] - offsets[i], np.arange(i, j)
            i = j
            continue
        at, end, want = int(offsets[i]), int(offsets[i + 1]), size
        while at < end:
            stop = min(end, at + want)
            if stop < end:
                ok = np.flatnonzero(cut(data[at : stop + 1])[1:])
                if not len(ok):
                    want *= 2
                    continue
                stop = at + 1 + int(ok[-1])
            yield data[at:stop], np.zeros(1, np.int64), np.array([i])
            at, want = stop, size
        i += 1


def word_starts(b: np.ndarray) -> np.ndarray:
    """Words: runs without ASCII white space. True where one starts (white space belongs to none)."""
    s = ~WHITE[b]
    s[1:] &= WHITE[b[:-1]]
    return s


def spaced_starts(b: np.ndarray) -> np.ndarray:
    """White space with the run that follows it. True where ASCII white space follows something that is no white space of Unicode."""
    w = WHITE[b]
    s = np.zeros(len(b), bool)
    s[1:] = w[1:] & ~w[:-1]
    at = np.flatnonzero(s)
    at = at[b[at - 1] >= 0x80]  # after a character beyond ASCII, which may be white space itself
    code = b[np.maximum(at - 3, 0)].astype(np.int32) << 16 | b[np.maximum(at - 2, 0)].astype(np.int32) << 8 | b[at - 1]
    s[at[np.isin(code, _WIDE_WHITE) | np.isin(code & 0xFFFF, _WIDE_WHITE)]] = False
    return s


class Units:
    """The units of a block: where they start and how long they are, to which piece they belong, and their hashes."""

    def __init__(self, b: np.ndarray, pieces: np.ndarray, starts: Callable[[np.ndarray], np.ndarray], bare: bool):
        """``bare``: white space belongs to no unit and is not hashed."""
        self.data = b
        mark = starts(b)
        inner = pieces[pieces < len(b)]
        mark[inner] = ~WHITE[b[inner]] if bare else True
        self.at = np.flatnonzero(mark)
        size = np.diff(self.at, append=len(b))
        self.first = int(self.at[0]) if len(self.at) else len(b)
        self.place = np.arange(len(b) - self.first, dtype=np.int32) - np.repeat((self.at - self.first).astype(np.int32), size)
        if bare:  # a unit ends at its first white space, or where the next piece starts
            white = np.add.reduceat(WHITE[b].astype(np.int64), self.at) if len(self.at) else size
            self.size = size - white
        else:
            self.size = size
        self.bounds = np.searchsorted(self.at, np.append(pieces, len(b)))
        self.bare = bare

    def hashes(self) -> np.ndarray:
        if not len(self.at):
            return np.zeros(0, np.uint64)
        table = np.where(WHITE, np.uint64(0), _BYTE) if self.bare else _BYTE
        v = table[self.data[self.first :]]
        v *= weights(self.place)
        h = np.add.reduceat(v, self.at - self.first)
        return mix(h + self.size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def distinct(self, h: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(an index of each distinct unit, for each unit the number of its distinct one); equal hashes are checked byte by byte."""
        if not len(self.at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        h = self.hashes() if h is None else h
        order = np.argsort(h)
        ordered = h[order]
        new = np.append(True, ordered[1:] != ordered[:-1])
        inverse = np.empty(len(h), np.int64)
        inverse[order] = np.cumsum(new) - 1
        first = order[new]
        rep = first[inverse]
        same = bool((self.size[rep] == self.size).all())
        if same:
            other = np.arange(self.first, len(self.data), dtype=np.int32)
            other += np.repeat((self.at[rep] - self.at).astype(np.int32), np.diff(self.at, append=len(self.data)))
            other = self.data[np.minimum(other, len(self.data) - 1, out=other)]
            unequal = other != self.data[self.first :]
            if self.bare:
                unequal &= ~WHITE[self.data[self.first :]]
            same = not unequal.any()
        if not same:  # two units share a hash: number them by their bytes
            names: dict[bytes, int] = {}
            inverse = np.array([names.setdefault(x, len(names)) for x in self.take(np.arange(len(self.at)))])
            first = np.unique(inverse, return_index=True)[1]
        return first, inverse

    def bytes_of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of these units one after another, and their sizes."""
        return ragged(self.data, self.at[which], self.size[which]), self.size[which]

    def take(self, which: np.ndarray) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[a : a + n] for a, n in zip(self.at[which].tolist(), self.size[which].tolist(), strict=True)]


class UnitCache:
    """Ids of units seen before, in flat arrays: open addressing by hash, bytes compared with the stored ones, ids in one buffer.

    Holds ``most`` units at most; what comes after is not kept, which
    changes no result. Two units with one hash are told apart by their
    bytes, and only the first of them is kept.
    """

    def __init__(self, most: int, longest: int = 63):
        self.most, self.longest, self.n = most, longest, 0
        self.bits = 12
        self.slots = np.full(1 << self.bits, -1, np.int32)
        self.keys = np.zeros(1 << 11, np.uint64)
        self.start = np.zeros((1 << 11, 2), np.int64)  # of a unit's bytes and of its ids
        self.size = np.zeros((1 << 11, 2), np.int32)
        self.raw, self.ids = np.zeros(1 << 14, np.uint8), np.zeros(1 << 13, np.int32)
        self.used = [0, 0]

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, h: np.ndarray, raw: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Number of each unit (hash, its bytes in ``raw`` one after another, sizes), -1 where it is not known."""
        found = self.with_hash(h)
        known = np.flatnonzero(found >= 0)
        other = self.size[found[known], 0] != size[known]
        found[known[other]] = -1
        known = known[~other]
        if len(known):
            starts = np.cumsum(size) - size
            unequal = ragged(raw, starts[known], size[known]) != ragged(self.raw, self.start[found[known], 0], size[known])
            bad = np.add.reduceat(unequal, np.cumsum(size[known]) - size[known], dtype=np.int64) > 0
            found[known[bad]] = -1
        return found

    def _grown(self, a: np.ndarray, n: int) -> np.ndarray:
        if n <= len(a):
            return a
        out = np.zeros((max(n, 2 * len(a)), *a.shape[1:]), a.dtype)
        out[: len(a)] = a
        return out

    def _seat(self, numbers: np.ndarray) -> None:
        """Puts stored units, of different hashes, into free slots."""
        at, mask = self._slot(self.keys[numbers]), (1 << self.bits) - 1
        while len(numbers):
            free = self.slots[at] < 0
            self.slots[at[free]] = numbers[free]
            left = self.slots[at] != numbers
            at, numbers = (at[left] + 1) & mask, numbers[left]

    def add(self, h: np.ndarray, raw: np.ndarray, size: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Keeps units that ``find`` did not know, as far as there is room."""
        _, first = np.unique(h, return_index=True)
        first = first[(size[first] > 0) & (size[first] <= self.longest)]
        first = first[self.with_hash(h[first]) < 0][: self.most - self.n]
        if not len(first):
            return
        n, m = self.n, self.n + len(first)
        self.keys, self.start, self.size = self._grown(self.keys, m), self._grown(self.start, m), self._grown(self.size, m)
        for k, (flat, sizes) in enumerate(((raw, size), (ids, counts))):
            part = ragged(flat, (np.cumsum(sizes) - sizes)[first], sizes[first])
            held = self._grown(self.raw if k == 0 else self.ids, self.used[k] + len(part))
            held[self.used[k] : self.used[k] + len(part)] = part
            self.start[n:m, k] = self.used[k] + np.cumsum(sizes[first]) - sizes[first]
            self.size[n:m, k] = sizes[first]
            self.used[k] += len(part)
            if k == 0:
                self.raw = held
            else:
                self.ids = held
        self.keys[n:m] = h[first]
        self.n = m
        if 2 * m > 1 << self.bits:
            while 2 * m > 1 << self.bits:
                self.bits += 1
            self.slots = np.full(1 << self.bits, -1, np.int32)
            self._seat(np.arange(m, dtype=np.int32))
        else:
            self._seat(np.arange(n, m, dtype=np.int32))

    def with_hash(self, h: np.ndarray) -> np.ndarray:
        """Number of the unit kept under each hash, -1 where there is none."""
        at, mask = self._slot(h), (1 << self.bits) - 1
        found = self.slots[at].astype(np.int64)
        left = np.flatnonzero((found >= 0) & (self.keys[found] != h))
        while len(left):
            at[left] = (at[left] + 1) & mask
            found[left] = self.slots[at[left]]
            left = left[(found[left] >= 0) & (self.keys[found[left]] != h[left])]
        return found


#: ASCII letters in lower case, ASCII punctuation as spaces, all else as it is.
PLAIN = np.arange(256, dtype=np.uint8)
PLAIN[65:91] += 32
PLAIN[[c for c in range(33, 127) if not chr(c).isalnum()]] = 32


def word_hashes(column: pa.Array, as_: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a column, and the n+1 offsets of its rows among them; ``as_``: what each byte is read as."""
    data, offsets = text_bytes(column)
    if as_ is not None:
        data, offsets = as_[data[offsets[0] : offsets[-1]]], offsets - offsets[0]
    parts, counts = [], np.zeros(len(offsets) - 1, np.int64)
    for b, pieces, rows in blocks(data, offsets, lambda x: WHITE[x]):
        u = Units(b, pieces, word_starts, True)
        parts.append(u.hashes())
        np.add.at(counts, rows, np.diff(u.bounds))
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.append(0, np.cumsum(counts))


def give_back() -> None:
    """Hands freed memory back to the system, so that a worker reused by later stages does not hold it."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


#: Tables that a worker keeps from task to task: vocabularies with their caches, powers of a hash's base.
TABLES: list[dict] = []


def forget(*used: dict) -> None:
    """Drops what a reused worker keeps for other steps than the one that begins; ``used``: the tables of that step."""
    for table in TABLES:
        if not any(table is x for x in used):
            table.clear()
    give_back()


def ragged(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs flat[starts[k] : starts[k] + sizes[k]] one after another."""
    total = int(sizes.sum())
    before = np.cumsum(sizes) - sizes
    return flat[np.repeat(starts - before, sizes) + np.arange(total)]


def text_batches(batch: pa.RecordBatch, name: str = "text", size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of text each."""
    _, offsets = text_bytes(batch.column(name))
    give_back()  # what the batch before it left
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j
    give_back()
