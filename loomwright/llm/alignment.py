"""Alignment of the tokens of two vocabularies over whole texts.

A slice of an Arrow batch is read as one run of bytes with the offsets of its
documents. The ends of the tokens of both vocabularies are counted once over
that run; it is cut where both have one. What a document has of tokens,
groups and links are differences of prefix sums at its ends.

A link is a pair of overlapping tokens. Between two neighbouring ends (of
either vocabulary) lies exactly one pair, so there are as many links as
there are distinct ends, and none is made by comparing tokens.

How many documents hold a pair of ids is counted over the corpus. Each slice
sends its distinct pairs with their documents already counted; the counts
come back to the slice, not to every document, and meet there the documents'
own pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.llm.bytesets import UnitCache, Units, blocks, give_back, ragged, text_batches, text_bytes
from loomwright.llm.common import materialise
from loomwright.llm.piece_codec import vocabulary
from loomwright.llm.token_counts import Counter

SLICE = 2 << 20
_CACHE_UNITS = 300_000  # of each vocabulary
#: Bits of the second id in the number of a pair.
_ID_BITS = 31
_CODEC = "zstd"


def byte_letters() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: itself where it is printable, else the next free one from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class PlainCounter(Counter):
    """A byte-level vocabulary that reads the strings of its special tokens as plain text, with the bytes of each id."""

    def __init__(self, path: str):
        super().__init__(path)
        self.cache = UnitCache(_CACHE_UNITS)
        self.tokenizer.encode_special_tokens = True
        letters = byte_letters()
        entries = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        raw = [bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in (entries.get(i, "") for i in range(max(entries) + 1))]
        self.surface_size = np.array([len(x) for x in raw], np.int64)
        self.surface_at = np.cumsum(self.surface_size) - self.surface_size
        self.surface = np.frombuffer(b"".join(raw), np.uint8)

    def _joined(self, between: bytes, part: list[bytes], mark: int) -> tuple[np.ndarray, np.ndarray] | None:
        self.tokenizer.encode_special_tokens = False  # the token between the units is a special one; none of them holds its string
        try:
            return super()._joined(between, part, mark)
        finally:
            self.tokenizer.encode_special_tokens = True


_loaded: dict[str, PlainCounter] = {}


def plain_counter(path: str) -> PlainCounter:
    """One per worker process, with its cache of units."""
    if path not in _loaded:
        _loaded[path] = PlainCounter(path)
    return _loaded[path]


class PieceCoder:
    """A sentencepiece vocabulary over whole columns: distinct units between places that no piece reaches across, new ones encoded by the library."""

    def __init__(self, path: str):
        self.vocab = vocabulary(path)
        self.cache = UnitCache(_CACHE_UNITS)
        self.surface, self.surface_at, self.surface_size = self.vocab.surface, self.vocab.surface_at, self.vocab.surface_size

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, the space put before each text included, and their n+1 offsets."""
        data, offsets = text_bytes(column)
        flat, counts = [], np.zeros(len(offsets) - 1, np.int64)
        starts = self.vocab.unit_starts
        for b, pieces, rows in blocks(data, offsets, starts):
            heads = np.array([offsets[r] < offsets[r + 1] for r in rows]) & ((len(rows) > 1) | (b.ctypes.data == data.ctypes.data + offsets[rows[0]]))
            fed = np.insert(b, pieces[heads], 32)  # the space that is put before a text
            u = Units(fed, pieces + np.cumsum(heads) - heads, starts, False)
            h = u.hashes()
            first, inverse = u.distinct(h)
            h = h[first]
            raw, size = u.bytes_of(first)
            known = self.cache.find(h, raw, size)
            new, old = np.flatnonzero(known < 0), np.flatnonzero(known >= 0)
            ids, n = self._library(u.take(first[new]))
            sizes, begins = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
            sizes[old], begins[old] = self.cache.size[known[old], 1], self.cache.start[known[old], 1]
            sizes[new], begins[new] = n, self.cache.used[1] + np.cumsum(n) - n
            flat.append(ragged(np.concatenate([self.cache.ids[: self.cache.used[1]], ids]), begins[inverse], sizes[inverse]))
            self.cache.add(h[new], ragged(raw, (np.cumsum(size) - size)[new], size[new]), size[new], ids, n)
            np.add.at(counts, rows, np.diff(np.append(0, np.cumsum(sizes[inverse]))[u.bounds]))
        return (np.concatenate(flat) if flat else np.zeros(0, np.int32)), np.append(0, np.cumsum(counts))

    def _library(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after another, how many each unit has); the library puts a space before what it is given, so others stand behind a line feed."""
        texts = [x.decode() for x in units]
        spaced = [len(t) > 1 and t.startswith(" ") for t in texts]  # of nothing the library makes no space
        got = self.vocab.library.encode([t[1:] if s else "\n" + t for t, s in zip(texts, spaced, strict=True)], num_threads=1) if texts else []
        got = [x if s else x[2:] for x, s in zip(got, spaced, strict=True)]
        n = np.array([len(x) for x in got], np.int64)
        return np.fromiter(chain.from_iterable(got), np.int32, int(n.sum())), n


_coders: dict[str, PieceCoder] = {}


def piece_coder(path: str) -> PieceCoder:
    """One per worker process, with its cache of units."""
    if path not in _coders:
        _coders[path] = PieceCoder(path)
    return _coders[path]


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of each segment, by differences of prefix sums."""
    return np.diff(np.append(0, np.cumsum(values))[bounds])


def _chosen(ids: np.ndarray, bounds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and bounds of these rows alone."""
    sizes = np.diff(bounds)[rows]
    return ragged(ids, bounds[:-1][rows], sizes), np.append(0, np.cumsum(sizes))


class _Side:
    """Tokens of the aligned documents of a slice under one vocabulary."""

    def __init__(self, coder, ids: np.ndarray, bounds: np.ndarray):
        self.coder, self.ids, self.bounds = coder, ids.astype(np.int64), bounds
        self.size = coder.surface_size[self.ids]

    def only(self, rows: np.ndarray) -> _Side:
        return _Side(self.coder, *_chosen(self.ids, self.bounds, rows))

    def lengths(self) -> np.ndarray:
        return _sums(self.size, self.bounds)

    def bytes(self) -> np.ndarray:
        return ragged(self.coder.surface, self.coder.surface_at[self.ids], self.size)


class Aligned:
    """Groups and links of the documents of a slice; ``rows`` are those whose bytes both vocabularies give back."""

    def __init__(self, column: pa.Array, first: PlainCounter, second):
        spaced = pc.binary_join_element_wise(pa.scalar(" ", column.type), pc.fill_null(column, ""), pa.scalar("", column.type))
        data, offsets = text_bytes(spaced)
        a, b = _Side(first, *first.encode(spaced)), _Side(second, *second.encode(column))
        want = np.diff(offsets)
        rows = np.flatnonzero((want > 1) & (a.lengths() == want) & (b.lengths() == want))
        if len(rows) < len(want):
            a, b = a.only(rows), b.only(rows)
            text = ragged(data, offsets[:-1][rows], want[rows])
        else:
            text = data[offsets[0] : offsets[-1]]
        unequal = text != a.bytes()
        unequal |= text != b.bytes()
        if unequal.any():
            same = _sums(unequal, np.append(0, np.cumsum(want[rows]))) == 0
            a, b, rows = a.only(np.flatnonzero(same)), b.only(np.flatnonzero(same)), rows[same]
        self.rows, self.a, self.b = rows, a, b
        ends = np.cumsum(want[rows])  # of the documents
        total = int(ends[-1]) if len(ends) else 0
        in_a = np.bincount(np.cumsum(a.size), minlength=total + 1)
        in_b = np.bincount(np.cumsum(b.size), minlength=total + 1)
        cuts = np.flatnonzero(in_a | in_b)  # ends of either
        in_a, in_b = in_a[cuts], in_b[cuts]
        common = in_a & in_b
        group = np.cumsum(common) - common
        self.group_a, self.group_b = group[in_a > 0], group[in_b > 0]
        self.n_groups_all = int(common.sum())
        self.link_a, self.link_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        self.links = np.append(0, np.searchsorted(cuts, ends, "right"))  # bounds of the documents among links
        self.n_groups = _sums(common, self.links)

    def pairs(self) -> np.ndarray:
        """Number of the id pair of each link."""
        return (self.a.ids[self.link_a] << _ID_BITS) | self.b.ids[self.link_b]

    def digests(self) -> list[str]:
        """Of each document, the hash of its groups as text."""
        a, b = self.a, self.b
        per_a = np.bincount(self.group_a, minlength=self.n_groups_all)
        per_b = np.bincount(self.group_b, minlength=self.n_groups_all)
        before_a, before_b = np.cumsum(per_a) - per_a, np.cumsum(per_b) - per_b
        place_a = np.arange(len(a.ids)) + before_b[self.group_a]  # a group's first ids, then its second ones
        place_b = np.arange(len(b.ids)) + (before_a + per_a)[self.group_b]
        sign = np.full(len(a.ids) + len(b.ids), ord(","), np.uint8)
        sign[(before_a + before_b)] = ord(";")
        sign[(before_a + per_a + before_b)] = ord("|")
        bounds = a.bounds + b.bounds
        sign[bounds[:-1]] = 0
        ids = np.empty(len(sign), np.int64)
        ids[place_a], ids[place_b] = a.ids, b.ids
        table, digits = _decimal(int(ids.max()) + 1 if len(ids) else 1)
        cells = np.empty((len(ids), table.shape[1] + 1), np.uint8)
        cells[:, 0] = sign
        cells[:, 1:] = table[ids]
        flat = cells.reshape(-1)
        flat = flat[flat > 0].tobytes()
        at = np.append(0, np.cumsum(digits[ids] + (sign > 0)))[bounds].tolist()
        return [hashlib.sha256(flat[x:y]).hexdigest() for x, y in zip(at[:-1], at[1:], strict=True)]


_decimals: list[tuple[np.ndarray, np.ndarray]] = []


def _decimal(n: int) -> tuple[np.ndarray, np.ndarray]:
    """(decimal digits of 0..n-1 or beyond, from the left, 0 where there are no more; how many each has)."""
    if not _decimals or len(_decimals[0][0]) < n:
        n = max(n, 1 << 16)
        width = len(str(n - 1))
        text = np.char.mod("%d", np.arange(n)).astype(f"S{width}")
        table = np.frombuffer(text.tobytes(), np.uint8).reshape(n, width)
        _decimals[:] = [(table, (table > 0).sum(1))]
    return _decimals[0]


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(np.ascontiguousarray(values, np.uint32).tobytes(), _CODEC, asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, 4 * n, _CODEC, asbytes=True), np.uint32).astype(np.int64)


def aligned_slices(docs: DataFrame, first: str, second: str, id_column: str = "doc_id", text_column: str = "text", size: int = SLICE) -> DataFrame:
    """The slices' rows: one for each document with what it has of tokens, groups and links, and one for each slice with its distinct pairs.

    A document's own pairs are places in the sorted pairs of its ``slice``
    (differences, compressed) and how often each is linked. The row of a
    slice has ``pairs`` and ``n_docs`` alone.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    fields = f"doc_id {kind}, slice long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_pairs int, places binary, times binary, pairs array<long>, n_docs array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for whole in batches:
            for batch in text_batches(whole, text_column, size):
                number += 1
                yield from _slice_rows(batch, number)
                give_back()

    def _slice_rows(batch: pa.RecordBatch, number: int) -> Iterator[pa.RecordBatch]:
        n = batch.num_rows
        got = Aligned(batch.column(text_column), plain_counter(first), piece_coder(second))
        pairs, place = np.unique(got.pairs(), return_inverse=True)
        held = np.repeat(np.arange(len(got.rows)), np.diff(got.links)) * max(1, len(pairs)) + place  # (document, pair)
        held.sort()
        at = np.flatnonzero(np.append(True, held[1:] != held[:-1])) if len(held) else np.zeros(0, np.int64)
        times = np.diff(np.append(at, len(held)))
        row, place = np.divmod(held[at], max(1, len(pairs)))
        bounds = np.searchsorted(row, np.arange(len(got.rows) + 1)).tolist()
        steps = np.diff(place, prepend=0)
        steps[bounds[:-1]] = place[bounds[:-1]]
        columns = {c: np.zeros(n, np.int64) for c in ("n_a", "n_b", "n_groups", "n_links", "n_pairs")}
        for c, values in (("n_a", np.diff(got.a.bounds)), ("n_b", np.diff(got.b.bounds)), ("n_groups", got.n_groups), ("n_links", np.diff(got.links)), ("n_pairs", np.diff(bounds))):
            columns[c][got.rows] = values
        digests, places, often = [""] * n, [None] * n, [None] * n
        for k, digest, x, y in zip(got.rows.tolist(), got.digests(), bounds[:-1], bounds[1:], strict=True):
            digests[k], places[k], often[k] = digest, _packed(steps[x:y]), _packed(times[x:y])
        none = pa.nulls
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(id_column), pa.array(np.full(n, number)), *(pa.array(columns[c]) for c in ("n_a", "n_b", "n_groups", "n_links")), pa.array(digests, pa.string()),
                pa.array(columns["n_pairs"].astype(np.int32)), pa.array(places, pa.binary()), pa.array(often, pa.binary()), none(n, pa.list_(pa.int64())), none(n, pa.list_(pa.int32())),
            ],
            names,
        )
        if len(pairs):
            n_docs = np.bincount(place, minlength=len(pairs)).astype(np.int32)
            one = lambda v: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v))
            yield pa.RecordBatch.from_arrays(
                [none(1, batch.column(id_column).type), pa.array([number]), *(none(1, pa.int64()) for _ in range(4)), none(1, pa.string()), none(1, pa.int32()), none(1, pa.binary()), none(1, pa.binary()), one(pairs), one(n_docs)],
                names,
            )

    names = [x.split()[0] for x in fields.split(", ")]
    return docs.select(id_column, text_column).mapInArrow(run, fields)


def align_tokens(docs: DataFrame, first: str, second: str, id_column: str = "doc_id", text_column: str = "text", size: int = SLICE) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of each whole text.

    ``first`` is a byte-level .json vocabulary (fed with a space and the
    text), ``second`` a sentencepiece .model, both on every executor. Texts
    that are null or empty, or whose tokens do not give their bytes back, have
    zeros and an empty digest. A pair's count is the number of rows that hold
    it; repeated rows count each and stay, as do null ids. Other columns are
    not read; an empty table gives an empty result.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    slices = materialise(aligned_slices(docs, first, second, id_column, text_column, size))
    held = slices.where("pairs is not null").select(F.col("slice").alias("of_slice"), F.inline(F.arrays_zip(F.col("pairs").alias("pair"), "n_docs")))
    counts = materialise(held.groupBy("pair").agg(F.sum("n_docs").cast("long").alias("count")))
    of_first = F.shiftright("pair", _ID_BITS)
    best = counts.groupBy(of_first.alias("a")).agg(F.max("count").alias("most"))
    known = counts.join(best, of_first == F.col("a")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    back = held.select("of_slice", "pair").join(known, "pair")

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def fuse(rows: pa.Table, counted: pa.Table) -> pa.Table:
        """Sums over the links of a slice's documents; its pairs stand in the order of their numbers, as the documents' places do."""
        order = np.argsort(counted["pair"].to_numpy())
        count, top = counted["count"].to_numpy()[order], counted["best"].to_numpy().astype(np.int64)[order]
        rows = rows.combine_chunks()
        total, n_best = np.zeros(rows.num_rows, np.int64), np.zeros(rows.num_rows, np.int64)
        for k, (n, places, times) in enumerate(zip(rows["n_pairs"].to_pylist(), rows["places"], rows["times"], strict=True)):
            if n:
                place, often = np.cumsum(_unpacked(places.as_buffer(), n)), _unpacked(times.as_buffer(), n)
                total[k], n_best[k] = (count[place] * often).sum(), (top[place] * often).sum()
        return pa.table([rows["doc_id"], rows["n_a"], rows["n_b"], rows["n_groups"], rows["n_links"], pa.array(n_best), pa.array(total), rows["groups_sha256"]], names)

    of_docs = slices.where("pairs is null").drop("pairs", "n_docs")
    fields = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return of_docs.groupBy("slice").cogroup(back.groupBy("of_slice")).applyInArrow(fuse, fields)
