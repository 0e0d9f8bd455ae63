"""SentencePiece encoding and decoding for merge-type vocabularies.

Encoding keeps an agenda of adjacent symbol pairs ordered by score: the pair
whose joined piece scores best is merged first, the leftmost of equals, until
no pair joins to a piece. Symbols outside the vocabulary fall back to bytes.

A text is first cut into units at places where no piece of the vocabulary can
reach across (before a run of spaces, and around characters that no longer
piece contains), so each distinct unit of a block is encoded once. Every unit
that a worker meets for the first time is checked, in the same Arrow batch,
against the sentencepiece library, and so is one whole text of each batch.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from loomwright.llm.bytesets import Units, blocks, ragged, text_batches, text_bytes

SPACE = "▁"
_NONE = np.int64(1) << 40
_CACHE_UNITS = 400_000
_LONG_UNIT = 192
_PLACE_BITS = 20  # of a symbol's place in one agenda of many units
_AGENDA_UNITS = 15_000
_WHOLE_CHARS = 1 << 20  # texts of this length or more are checked by their units alone


class PairTable:
    """(left symbol, right symbol) -> joined symbol, or -1; open addressing in two arrays."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        self.bits = max(10, int(len(pairs) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.joined = np.full(1 << self.bits, -1, np.int64)
        for (a, b), c in pairs.items():
            k = (a << 20) | b
            at = int(self._slot(np.array([k]))[0])
            while self.keys[at] >= 0:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.keys[at], self.joined[at] = k, c

    def _slot(self, k: np.ndarray) -> np.ndarray:
        return ((k.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        k = (a.astype(np.int64) << 20) | b
        k[(a < 0) | (b < 0)] = -2
        at = self._slot(k)
        found = self.keys[at]
        out = np.where(found == k, self.joined[at], -1)
        left = np.flatnonzero((found != k) & (found >= 0))
        while len(left):
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)
            found = self.keys[at[left]]
            out[left] = np.where(found == k[left], self.joined[at[left]], -1)
            left = left[(found != k[left]) & (found >= 0)]
        return out


class MergeVocabulary:
    """Pieces, merge order and byte pieces of a sentencepiece model of merge type with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        if sp.normalize(probe := " ﬁ  a　") != f"{SPACE}{probe.replace(' ', SPACE)}":
            raise ValueError("the model must keep texts as they are, with a space put before them")
        n = sp.get_piece_size()
        normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.pieces = {sp.id_to_piece(i): i for i in normal}
        self.bytes_ = np.full(256, -1, np.int64)
        for i in range(n):
            if sp.is_byte(i):
                self.bytes_[int(sp.id_to_piece(i)[3:5], 16)] = i
        if (self.bytes_ < 0).any():
            raise ValueError("the model has no byte fallback")
        self.end_id = sp.eos_id()
        chars = sorted({c for p in self.pieces for c in p})
        extra = [c for c in chars if c not in self.pieces]  # characters that only occur in longer pieces
        self.symbols = self.pieces | {c: n + k for k, c in enumerate(extra)}
        scored = sorted(normal, key=lambda i: -sp.get_score(i))
        self.rank = np.full(n + len(extra) + 1, _NONE)
        last, r = None, -1
        for i in scored:  # equal scores share a rank
            if (s := sp.get_score(i)) != last:
                last, r = s, r + 1
            self.rank[i] = r
        self.pairs = {(self.symbols[p[:k]], self.symbols[p[k:]]): i for p, i in self.pieces.items() for k in range(1, len(p)) if p[:k] in self.symbols and p[k:] in self.symbols}
        self.table = PairTable(self.pairs)
        self.chars = np.full(0x110000, -1, np.int64)
        for c in chars:
            self.chars[ord(c)] = self.symbols[c]
        self.chars[32] = self.chars[ord(SPACE)]
        self.splits = not any(SPACE in p.lstrip(SPACE) for p in self.pieces)  # no piece has a space after something else
        joint = {c for p in self.pieces if len(p) > 1 for c in p}
        self.alone = np.array([c < 128 and chr(c) not in joint and c != 32 for c in range(256)])  # ASCII that never merges
        self.vocab = n
        surfaces = [b""] * n
        for p, i in self.pieces.items():
            surfaces[i] = p.replace(SPACE, " ").encode()
        for v, i in enumerate(self.bytes_.tolist()):
            surfaces[i] = bytes([v])
        surfaces[sp.unk_id()] = " ⁇ ".encode()
        self.surface_size = np.array([len(x) for x in surfaces])
        self.surface_at = np.cumsum(self.surface_size) - self.surface_size
        self.surface = np.frombuffer(b"".join(surfaces), np.uint8)
        self.is_byte = np.zeros(n, bool)
        self.is_byte[self.bytes_] = True
        self.skipped = np.array([sp.is_control(i) for i in range(n)])
        self.cache: dict[bytes, np.ndarray] = {}

    # -- encoding -------------------------------------------------------

    def unit_starts(self, b: np.ndarray) -> np.ndarray:
        s = np.zeros(len(b), bool)
        if self.splits:
            s[1:] = (b[1:] == 32) & (b[:-1] != 32)
            s[3:] &= ~((b[2:-1] == 0x81) & (b[1:-2] == 0x96) & (b[:-3] == 0xE2))  # a text's own U+2581 is a space too
        a = self.alone[b]
        s |= a
        s[1:] |= a[:-1]
        return s

    def ids(self, symbols: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Final symbols to ids: what is no piece becomes the bytes of its character."""
        odd = np.flatnonzero((symbols < 0) | (symbols >= self.vocab))
        if not len(odd):
            return symbols
        out, at = [], 0
        for k in odd.tolist():
            out += [symbols[at:k], self.bytes_[np.frombuffer(chr(points[k]).encode(), np.uint8)]]
            at = k + 1
        return np.concatenate([*out, symbols[at:]])

    def agenda_one(self, text: str) -> np.ndarray:
        """The agenda of one long unit: a heap of (rank, place) over a linked list of symbols."""
        points = np.array([ord(c) for c in text], np.int64)
        sym = self.chars[points].tolist()
        n = len(sym)
        left, right, heap = list(range(-1, n - 1)), [*range(1, n), -1], []

        def propose(i: int) -> None:
            j = right[i]
            if j >= 0 and (c := self.pairs.get((sym[i], sym[j]))) is not None:
                heapq.heappush(heap, (int(self.rank[c]), i, j, sym[i], sym[j], c))

        live = [True] * n
        for i in range(n):
            propose(i)
        while heap:
            _, i, j, a, b, c = heapq.heappop(heap)
            if not (live[i] and live[j] and right[i] == j and sym[i] == a and sym[j] == b):
                continue
            sym[i], live[j], right[i] = c, False, right[j]
            if right[i] >= 0:
                left[right[i]] = i
            if left[i] >= 0:
                propose(left[i])
            propose(i)
        keep = np.flatnonzero(live)
        return self.ids(np.array(sym, np.int64)[keep], points[keep])

    def agenda_many(self, texts: list[str]) -> list[np.ndarray]:
        """The agendas of many short units at once, of 2**20 characters at most: each round merges the best pair of every unit."""
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
        if len(points) > 1 << _PLACE_BITS:
            raise ValueError("more symbols than places")
        size = np.array([len(t) for t in texts])
        sym, owner = self.chars[points], np.repeat(np.arange(len(texts)), size)
        done_sym, done_point, done_owner = [], [], []
        joined = np.full(len(sym), -1, np.int64)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        joined[inner] = self.table(sym[inner], sym[inner + 1])
        while len(sym):
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            order = np.where(joined >= 0, self.rank[joined], _NONE) * (1 << _PLACE_BITS) + np.arange(len(sym))
            best = np.minimum.reduceat(order, starts)
            open_ = best < _NONE * (1 << _PLACE_BITS)
            runs = np.diff(starts, append=len(sym))
            if not open_.all():
                live = np.repeat(open_, runs)
                done_sym.append(sym[~live]), done_point.append(points[~live]), done_owner.append(owner[~live])
                moved = np.cumsum(live) - 1
                best = moved[best[open_] & ((1 << _PLACE_BITS) - 1)]
                sym, points, owner, joined = sym[live], points[live], owner[live], joined[live]
            else:
                best &= (1 << _PLACE_BITS) - 1
            if not len(sym):
                break
            sym[best] = joined[best]
            keep = np.ones(len(sym), bool)
            keep[best + 1] = False
            moved = np.cumsum(keep) - 1
            at = moved[best]
            sym, points, owner, joined = sym[keep], points[keep], owner[keep], joined[keep]
            for k in (at, at[at > 0] - 1):
                ok = np.zeros(len(k), bool)
                inside = k + 1 < len(sym)
                ok[inside] = owner[k[inside]] == owner[k[inside] + 1]
                joined[k] = -1
                joined[k[ok]] = self.table(sym[k[ok]], sym[k[ok] + 1])
        sym, points, owner = (np.concatenate(x) for x in (done_sym, done_point, done_owner))
        order = np.argsort(owner, kind="stable")
        sym, points, owner = sym[order], points[order], owner[order]
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
        whole = sym.astype(np.int32)
        ends = bounds.tolist()
        out = [whole[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        odd = np.unique(owner[(sym < 0) | (sym >= self.vocab)]).tolist()
        for k in odd:
            out[k] = self.ids(sym[ends[k] : ends[k + 1]], points[ends[k] : ends[k + 1]]).astype(np.int32)
        return out

    def encode_units(self, units: list[bytes]) -> list[np.ndarray]:
        """Ids of distinct units; those new to this worker are encoded by the agenda and checked with the library."""
        out = [self.cache.get(u) for u in units]
        new = [k for k, x in enumerate(out) if x is None]
        if new:
            texts = [units[k].decode() for k in new]
            short = [k for k, t in enumerate(texts) if 0 < len(t) <= _LONG_UNIT]
            got: list[np.ndarray] = [np.zeros(0, np.int64)] * len(texts)
            ends = np.cumsum([len(texts[k]) for k in short])
            a = 0
            while a < len(short):  # as many units as there are places for their characters
                z = min(a + _AGENDA_UNITS, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + (1 << _PLACE_BITS), "right")))
                part = short[a:z]
                for k, ids in zip(part, self.agenda_many([texts[k] for k in part]), strict=True):
                    got[k] = ids
                a = z
            for k, t in enumerate(texts):
                if len(t) > _LONG_UNIT:
                    got[k] = self.agenda_one(t)
            self.check(texts, got)
            for k, ids in zip(new, got, strict=True):
                out[k] = ids
                if len(self.cache) < _CACHE_UNITS and len(units[k]) < 64:
                    self.cache[units[k]] = ids.copy()
        return out

    def check(self, texts: list[str], got: list[np.ndarray]) -> None:
        """Stops the task if the library gives other ids for a unit."""
        # The library puts a space before each text: it stands for the one that starts a unit, or is held off by a
        # line feed where that merges with nothing.
        spaced = [k for k, t in enumerate(texts) if t.startswith(" ") and len(t) > 1]
        rest = [k for k, t in enumerate(texts) if not t.startswith(" ")] if self.alone[10] else []
        for which, fed, skip in ((spaced, [texts[k][1:] for k in spaced], 0), (rest, ["\n" + texts[k] for k in rest], 2)):
            if not which:
                continue
            want = self.library.encode(fed, num_threads=1)
            sizes = np.array([len(got[k]) for k in which])
            theirs = np.array([len(x) for x in want]) - skip
            if not (sizes == theirs).all() or not np.array_equal(np.concatenate([got[k] for k in which]), np.fromiter(chain.from_iterable(x[skip:] for x in want), np.int64)):
                bad = next(k for k, x in zip(which, want, strict=True) if x[skip:] != got[k].tolist())
                raise AssertionError(f"unit {texts[bad]!r}: the library gives other ids than {got[bad].tolist()}")

    def encode(self, column: pa.Array, end: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a column one after another, and their n+1 offsets."""
        data, offsets = text_bytes(column)
        flat, counts = [], np.zeros(len(offsets) - 1, np.int64)
        for b, pieces, rows in blocks(data, offsets, self.unit_starts):
            heads = np.array([offsets[r] < offsets[r + 1] for r in rows]) & ((len(rows) > 1) | (b.ctypes.data == data.ctypes.data + offsets[rows[0]]))
            fed = np.insert(b, pieces[heads], 32)  # the space that is put before a text
            pieces = pieces + np.cumsum(heads) - heads
            u = Units(fed, pieces, self.unit_starts, False)
            first, inverse = u.distinct()
            ids = self.encode_units(u.take(first))
            size = np.array([len(x) for x in ids], np.int64)
            sizes = size[inverse]
            flat.append(ragged(np.concatenate(ids).astype(np.int32) if len(ids) else np.zeros(0, np.int32), (np.cumsum(size) - size)[inverse], sizes))
            np.add.at(counts, rows, np.diff(np.append(0, np.cumsum(sizes))[u.bounds]))
        ids = np.concatenate(flat) if flat else np.zeros(0, np.int32)
        bounds = np.append(0, np.cumsum(counts))
        if end:
            ids = np.insert(ids, bounds[1:], self.end_id)
            bounds = bounds + np.arange(len(bounds))
        return ids.astype(np.int32), bounds

    # -- decoding -------------------------------------------------------

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The text of each run of ids: surfaces joined, byte pieces as UTF-8 (bad ones as U+FFFD), one leading space taken off."""
        ids = np.asarray(ids, np.int64)
        size = self.surface_size[ids]
        raw = ragged(self.surface, self.surface_at[ids], size).tobytes()
        at = np.append(0, np.cumsum(size))[bounds].tolist()
        out = []
        for k, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
            run = ids[bounds[k] : bounds[k + 1]]
            shown = run[~self.skipped[run]] if len(run) < 64 else run
            piece = raw[a:b]
            if piece[:1] == b" " and not self.is_byte[shown[0]]:
                piece = piece[1:]
            try:
                out.append(piece.decode())
            except UnicodeDecodeError:
                out.append(self.decode_bad(run))
        return out

    def decode_bad(self, run: np.ndarray) -> str:
        """Byte pieces that are no UTF-8: each byte outside a valid character becomes U+FFFD."""
        out, k, ids = [], 0, run.tolist()
        surface = self.surface.tobytes()
        while k < len(ids):
            e = k
            while e < len(ids) and self.is_byte[ids[e]]:
                e += 1
            if e > k:
                chunk, at = bytes(surface[self.surface_at[i]] for i in ids[k:e]), 0
                while at < len(chunk):
                    for n in (1, 2, 3, 4):
                        try:
                            out.append(chunk[at : at + n].decode())
                            at += n
                            break
                        except UnicodeDecodeError:
                            continue
                    else:
                        out.append("�")
                        at += 1
                k = e
            else:
                out.append(surface[self.surface_at[ids[k]] : self.surface_at[ids[k]] + self.surface_size[ids[k]]].decode())
                k += 1
        text = "".join(out)
        return text[1:] if text.startswith(" ") and not self.is_byte[ids[0]] else text


_loaded: dict[str, MergeVocabulary] = {}


def vocabulary(path: str) -> MergeVocabulary:
    """One per worker process, with its cache of units."""
    if path not in _loaded:
        _loaded[path] = MergeVocabulary(path)
    return _loaded[path]


def encode_texts(docs: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text", end: bool = True) -> DataFrame:
    """``doc_id, ids array<int>, decoded string``: sentencepiece ids of each whole text, and what they decode to.

    ``model`` is the path of the .model file on every executor. Null texts
    count as empty; an empty text has the end id alone (none with
    ``end=False``). Rows are independent: repeated rows and null ids stay as
    they are, other columns are not read. A text whose ids differ from the
    library's stops the job.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model)
        for whole in batches:
            checked = False
            for batch in text_batches(whole, text_column, 4 << 20):
                column = batch.column(text_column)
                ids, bounds = vocab.encode(column, end)
                if not checked:  # a whole text of each Arrow batch, against the library: the first that is neither empty nor too long
                    sizes = pc.fill_null(pc.utf8_length(column), 0).to_numpy(zero_copy_only=False)
                    for row in np.flatnonzero((sizes > 0) & (sizes < _WHOLE_CHARS))[:1].tolist():
                        text, checked = column[row].as_py(), True
                        if vocab.library.encode(text, add_eos=end) != ids[bounds[row] : bounds[row + 1]].tolist():
                            raise AssertionError(f"the library gives other ids for {text[:200]!r}")
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(id_column), lists, pa.array(vocab.decode(ids, bounds), pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select(id_column, text_column).mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")
