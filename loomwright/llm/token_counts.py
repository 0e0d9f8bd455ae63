"""Token ids and counts of whole texts as a tokenizers (.json) or sentencepiece (.model) vocabulary gives them.

Huge documents are encoded in overlapping chunks with offsets. Two chunks are
spliced at a place where both have a boundary between pre-tokens and that is
proven stable: the left chunk sees more than the longest added token beyond
it, the right one starts that much before it. Pre-tokenizers scan from left
to right and merges stay within a pre-token, so what follows such a place
depends on the text after it alone. Without such a place the overlap is
widened until there is one, or until the chunk holds all that is left.

Shorter texts are cut where ASCII white space begins a run of white space (of
Unicode, as the patterns read it); no pre-token of the known patterns reaches
across, so that each distinct unit of a block is encoded once. Where the
pattern drops white space, words are cut further, between ASCII characters
that no pre-token joins, and read in lower case if the vocabulary does that,
so that a word is one unit whatever marks and capitals it has.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loomwright.llm.bytesets import TABLES, WHITE, UnitCache, Units, blocks, ragged, spaced_starts, text_batches, text_bytes, word_starts

CHUNK_CHARS = 1 << 16
OVERLAP_CHARS = 1 << 10
_CACHE_UNITS = 600_000
_BLOCK = 1 << 20
_MOST_JOINED = 4000
_MOST_PLAIN = 1000
#: Pre-tokenizer patterns (fixed values) in which a match never holds white space after something else.
_KNOWN = {
    "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+": True,  # white space is dropped
}
#: The normaliser that is known to lower each character by itself, after characters were composed.
_LOWERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
#: Kinds of bytes: white space, letter, digit, other, apostrophe, beyond ASCII.
_KIND = np.full(256, 3, np.uint8)
_KIND[WHITE] = 0
_KIND[[c for c in range(128) if chr(c).isalpha()]] = 1
_KIND[48:58] = 2
_KIND[ord("'")] = 4
_KIND[128:] = 5
#: Whether a unit starts at the second of two kinds. No match of the known pattern holds both then: only after an apostrophe do letters
#: go on with what is before them, and what is beyond ASCII may change the kind of the character before it.
_APART = np.zeros(36, bool)
_APART[[6 * a + b for a, after in enumerate(((1, 2, 3, 4, 5), (2, 3, 4), (1, 3, 4), (1, 2), (2,), ())) for b in after]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def part_starts(b: np.ndarray) -> np.ndarray:
    """Parts of words: runs without ASCII white space, cut between ASCII characters of which no match of the known pattern holds both."""
    kind = _KIND[b]
    s = np.zeros(len(b), bool)
    s[:1] = kind[:1] > 0
    s[1:] = _APART[kind[:-1] * np.uint8(6) + kind[1:]]
    return s


def lowered(b: np.ndarray) -> np.ndarray:
    """ASCII capitals in lower case, but for those before a character beyond ASCII, with which they may be composed first."""
    out = _LOWER[b]
    kept = np.flatnonzero(b[1:] >= 0x80)
    out[kept] = b[kept]
    return out


class Counter:
    """A tokenizers vocabulary with its cache of units; one per worker process."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(self.tokenizer.to_str())
        added = spec.get("added_tokens") or []
        self.longest_added = max([0, *(len(t["content"]) for t in added)])
        plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] or any(c.isspace() for c in t["content"]) for t in added)
        pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        steps = pre.get("pretokenizers", [pre])
        pattern = (steps[0].get("pattern") or {}).get("Regex")
        self.bare = plain and _KNOWN.get(pattern, False)  # units are words alone
        self.spaced = plain and norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        self.mark, self.mark_id = next(((t["content"].encode(), t["id"]) for t in added if plain and t["special"] and not t["normalized"]), (None, -1))
        self.cache = UnitCache(_CACHE_UNITS)
        self.apart = self._separator() if self.bare else None
        self.marks = [t["content"].encode().lower() for t in added]  # a block that holds one is not cut within words
        self.lowers = (norm or {}).get("type") == "Sequence" and norm["normalizers"] == _LOWERS
        self.plain = self._plain(steps[1:]) if self.apart and self.lowers else None

    def encode_whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _separator(self) -> tuple[bytes, int] | None:
        """An ASCII character that is one token whatever stands around it: words joined by it between spaces can be told apart again."""
        for c in "~|^#":  # no other character is normalised to one of these
            got = self.encode_whole([c, f"a {c} b", f"a{c}{c}b", f"a{c}b"])
            if len(got[0]) == 1 and got[1].count(got[0][0]) == 1:
                return c.encode(), got[0][0]
        return None

    def _plain(self, after: list[dict]) -> object | None:
        """The model without a normaliser and the pattern, for words of a to z alone: both leave them as they are, and so does the byte level."""
        from tokenizers import Tokenizer, pre_tokenizers

        if after != [{"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]:
            return None
        plain = Tokenizer(self.tokenizer.model)
        plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        between, mark = self.apart
        return plain if plain.encode(f"a {between.decode()} b", add_special_tokens=False).ids.count(mark) == 1 else None

    def encode_units(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after another, how many each unit has) of many short units; words of a to z go to the model by themselves."""
        if self.plain is None:
            return self._encode_units(raw)
        is_plain = np.array([x.isalpha() and x.islower() for x in raw], bool)
        out = [(np.flatnonzero(~is_plain), *self._encode_units([x for x, p in zip(raw, is_plain.tolist(), strict=True) if not p]))]
        which = np.flatnonzero(is_plain)
        between, mark = b" " + self.apart[0] + b" ", self.apart[1]
        for k in range(0, len(which), _MOST_PLAIN):
            part = which[k : k + _MOST_PLAIN]
            ids = np.array(self.plain.encode_batch_fast([between.join([raw[i] for i in part.tolist()]).decode()], add_special_tokens=False)[0].ids, np.int32)
            out.append((part, *_told_apart(ids, mark)))
        return _in_place(out)

    def _encode_units(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids one after another, how many each unit has) of many short units.

        Many are handed to the library at once. Words (their white space is
        dropped) are joined by a token of one character that none of them
        holds, other units by an added token, which separates as the ends of
        a text do.
        """
        flat: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        for k in range(0, len(raw), _MOST_JOINED):
            part = raw[k : k + _MOST_JOINED]
            got = None
            if self.apart is not None:
                between, mark = self.apart
                held = [x for x in part if between in x]
                if not held:
                    got = self._joined(b" " + between + b" ", part, mark)
                elif len(held) < len(part):  # words that hold the character go by the other way
                    got = self._merged(part, between)
            if got is None and self.mark is not None:
                got = self._joined(self.mark, part, self.mark_id)
            if got is None:
                ids = self.encode_whole([x.decode() for x in part])
                got = np.array([i for x in ids for i in x], np.int32), np.array([len(x) for x in ids], np.int64)
            flat.append(got[0])
            counts.append(got[1])
        return (np.concatenate(flat), np.concatenate(counts)) if flat else (np.zeros(0, np.int32), np.zeros(0, np.int64))

    def _joined(self, between: bytes, part: list[bytes], mark: int) -> tuple[np.ndarray, np.ndarray] | None:
        joined = between.join(part)
        if joined.count(between.strip()) != len(part) - 1:
            return None
        flat, counts = _told_apart(np.array(self.encode_whole([joined.decode()])[0], np.int32), mark)
        return (flat, counts) if len(counts) == len(part) else None

    def _merged(self, part: list[bytes], between: bytes) -> tuple[np.ndarray, np.ndarray]:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for which in ([k for k, x in enumerate(part) if between not in x], [k for k, x in enumerate(part) if between in x]):
            units = [part[k] for k in which]
            got = self._joined(b" " + between + b" ", units, self.apart[1]) if not out else self._joined(self.mark, units, self.mark_id) if self.mark is not None else None
            if got is None:
                ids = self.encode_whole([x.decode() for x in units])
                got = np.array([i for x in ids for i in x], np.int32), np.array([len(x) for x in ids], np.int64)
            out.append((np.array(which), *got))
        return _in_place(out)

    def encode_huge(self, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> np.ndarray:
        """Ids of one long text from overlapping chunks; equal to encoding it at once."""
        margin = self.longest_added + 2
        out: list[np.ndarray] = []
        begin = 0
        ids, ends, stable = self._chunk(text, 0, chunk)
        at = 0  # ids before this place are in ``out``
        while begin + chunk < len(text):
            wide, size = max(overlap, 2 * margin + 2), chunk
            while True:
                start = max(begin, begin + size - wide)
                more = self._chunk(text, start, max(chunk, 2 * wide))
                common = np.intersect1d(stable, more[2], assume_unique=True)
                common = common[(common >= start + margin) & (common <= begin + size - margin) & (common >= at)]
                if len(common):
                    break
                if start == begin:  # all of this chunk was in the overlap: it takes the place of both
                    size = max(chunk, 2 * wide)
                    ids, ends, stable = more
                    if begin + size >= len(text):
                        break
                wide *= 2
            if not len(common):
                chunk = size
                break
            cut = int(common[-1])
            out.append(ids[(ends <= cut) & (ends > at)])
            at, begin, (ids, ends, stable) = cut, start, more
            chunk_now = max(chunk, 2 * wide)
            if begin + chunk_now >= len(text):
                break
            if chunk_now != chunk:  # a widened chunk: go on from its end
                chunk = chunk_now
        out.append(ids[ends > at])
        return np.concatenate(out)

    def _chunk(self, text: str, start: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, end of each in the text, places between pre-tokens) of text[start : start + size]."""
        e = self.tokenizer.encode(text[start : start + size], add_special_tokens=False)
        if not e.ids:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        spans = np.array(e.offsets, np.int64) + start
        words = np.array([-1 if w is None else w for w in e.word_ids])
        last = np.append(words[1:] != words[:-1], False)
        # a place between pre-tokens counts only where no token of a later one starts before it
        ends = np.maximum.accumulate(spans[:, 1])
        return np.array(e.ids), ends, np.unique(ends[last])

    def encode(self, column: pa.Array, chunk: int = CHUNK_CHARS) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a column one after another, and their n+1 offsets."""
        data, offsets = text_bytes(column)
        sizes = np.diff(offsets)
        huge = np.flatnonzero(sizes > chunk) if self.spaced else np.zeros(0, np.int64)
        if not (self.bare or self.spaced):  # no proof for units: the library reads each text whole
            got = self.encode_whole([x or "" for x in column.to_pylist()])
            return np.array([i for x in got for i in x], np.int32), np.append(0, np.cumsum([len(x) for x in got], dtype=np.int64))
        flat: list[np.ndarray] = []
        counts = np.zeros(len(sizes), np.int64)
        edges = [0, *(int(x) for h in huge for x in (h, h + 1)), len(sizes)]
        for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            if k % 2:
                ids = self.encode_huge(bytes(data[offsets[a] : offsets[b]]).decode(), chunk)
                flat.append(ids.astype(np.int32))
                counts[a] = len(ids)
            elif a < b:
                for part, rows, size in self._units(data, offsets[a : b + 1]):
                    flat.append(part)
                    np.add.at(counts, rows + a, size)
        return (np.concatenate(flat) if flat else np.zeros(0, np.int32)), np.append(0, np.cumsum(counts))

    def _marked(self, b: np.ndarray) -> bool:
        """Whether the bytes hold an added token, in whatever case."""
        low = _LOWER[b].tobytes()
        return any(x in low for x in self.marks)

    def _units(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for b, pieces, rows in blocks(data, offsets, spaced_starts, _BLOCK):
            starts = word_starts if self.bare else spaced_starts
            if self.bare and not self._marked(b):
                b, starts = lowered(b) if self.lowers else b, part_starts
            u = Units(b, pieces, starts, self.bare)
            h = u.hashes()
            first, inverse = u.distinct(h)
            h = h[first]
            raw, size = u.bytes_of(first)
            known = self.cache.find(h, raw, size)
            new = np.flatnonzero(known < 0)
            ids, counts = self.encode_units(u.take(first[new]))
            every = np.zeros(len(first), np.int64)
            begins = np.zeros(len(first), np.int64)
            old = np.flatnonzero(known >= 0)
            every[old], begins[old] = self.cache.size[known[old], 1], self.cache.start[known[old], 1]
            every[new], begins[new] = counts, self.cache.used[1] + np.cumsum(counts) - counts
            source = np.concatenate([self.cache.ids[: self.cache.used[1]], ids]) if len(old) else ids
            begins -= 0 if len(old) else self.cache.used[1]
            part, every = ragged(source, begins[inverse], every[inverse]), every[inverse]
            self.cache.add(h[new], ragged(raw, (np.cumsum(size) - size)[new], size[new]), size[new], ids, counts)
            yield part, rows, np.diff(np.append(0, np.cumsum(every))[u.bounds])


def _told_apart(ids: np.ndarray, mark: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids without the marks between units, and how many each unit has."""
    is_mark = ids == mark
    return ids[~is_mark], np.diff(np.append(np.flatnonzero(is_mark), len(ids)), prepend=-1) - 1


def _in_place(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Parts of units (their numbers, ids one after another, how many each has) in the order of their numbers."""
    place = np.argsort(np.concatenate([p[0] for p in parts]))
    counts = np.concatenate([p[2] for p in parts])
    flat = np.concatenate([p[1] for p in parts])
    return ragged(flat, (np.cumsum(counts) - counts)[place], counts[place]), counts[place]


loaded: dict[str, Counter] = {}
TABLES.append(loaded)


def counter(path: str) -> Counter:
    if path not in loaded:
        loaded[path] = Counter(path)
    return loaded[path]


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 512, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit``: tokens of each whole text.

    ``vocabulary`` is a .json (tokenizers) or .model (sentencepiece) file on
    every executor. Nothing is added or cut off; strings of special tokens
    in a text are read as the library does by default. Null texts count as
    empty (0 tokens); repeated rows and null ids stay; other columns are not
    read.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_batches(whole, text_column, 4 << 20):
                column = batch.column(text_column)
                if vocabulary.endswith(".model"):
                    from loomwright.llm.piece_codec import vocabulary as pieces

                    _, bounds = pieces(vocabulary).encode(column, end=False)
                else:
                    _, bounds = counter(vocabulary).encode(column)
                n = np.diff(bounds)
                yield pa.RecordBatch.from_arrays([batch.column(id_column), pa.array(np.diff(text_bytes(column)[1])), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(id_column, text_column).mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
