"""Removal of byte strings that occur more than once in the corpus, by prefix-free parsing.

1. Parsing. The rolling hash of an 8-byte window is a trigger where it is the
   least of the 96 windows that start a 200-byte string. A phrase runs from a
   trigger through the next one, so that equal 200-byte strings hold the same
   triggers and the same whole phrase. Each trigger stands for a run of
   strings, those whose first trigger it is; the bytes they cover together
   are its context.
2. Dictionary and parse. Phrases meet by their hash. A phrase met once holds no
   repeat. Equal contexts are repeated as a whole, which settles the inside of
   copied passages. Contexts that share a phrase but differ are left over:
   the edges of repeats.
3. Corpus order. The left-over contexts are put in order from their triggers:
   the suffixes of phrases that end there (dictionary) are named byte by byte,
   the texts that follow (parse) are sorted with the lengths of their common
   prefixes. For each length of suffix, strings are equal when the suffix has
   one name and the sorted texts after it share the rest.
4. The bytes that repeated strings cover are removed from each document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from loomwright.llm.bytesets import TABLES, forget, mix, text_batches, text_bytes
from loomwright.llm.common import fresh, materialise, quoted, settled, text_rows, with_row_ids

_BLOCK = 2 << 20
_WINDOW = 8
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_powers: dict[str, np.ndarray] = {}
TABLES.append(_powers)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, _BLOCK + (1 << 16))
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", inverse)):
                step = np.full(size, base, np.uint64)
                step[0] = 1
                _powers[name] = np.multiply.accumulate(step)
    return _powers["up"][:n], _powers["down"][:n]


def _hash(prefix: np.ndarray, down: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the substrings [start, end) from prefix sums over their 8-byte windows."""
    return mix((prefix[end - _WINDOW + 1] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def triggers(b: np.ndarray, ends: np.ndarray, length: int, reach: int, contexts: bool = True) -> tuple[np.ndarray, ...]:
    """(trigger, first start, last start, phrase hash, context hash) for the strings of ``length`` bytes in a block.

    ``ends``: for each byte, the end of its document in the block. Without
    ``contexts``, their hashes are left at 0.
    """
    empty = tuple(np.zeros(0, np.int64) for _ in range(3)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    n = len(b) - _WINDOW + 1
    if len(b) < length:
        return empty
    windows = np.ndarray((n,), "<u8", b.tobytes(), strides=(1,))
    with np.errstate(over="ignore"):
        h = mix(windows + np.uint64(0x1234567))
        least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
        wide = 1
        while wide * 2 <= reach:
            least = np.minimum(least[:-wide], least[wide:])
            wide *= 2
        if wide < reach:
            least = np.minimum(least[: len(least) - (reach - wide)], least[reach - wide :])
        least = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        m = len(b) - length + 1
        starts = np.flatnonzero(ends[:m] - np.arange(m) >= length)
        if not len(starts):
            return empty
        at = least[starts]
        new = np.append(True, (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1))
        lo, at = starts[new], at[new]
        hi = starts[np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)]
        up, down = _power(n + 1)
        prefix = np.append(np.uint64(0), np.cumsum(h * up[:n]))
        following = least[at + 1]
        phrase = _hash(prefix, down, at, following + _WINDOW)
        if not contexts:
            return at, lo, hi, phrase, np.zeros(len(phrase), np.uint64)
        other = np.append(np.uint64(0), np.cumsum(mix(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)) * up[:n]))
        context = _hash(other, down, lo, hi + length) + (at - lo).astype(np.uint64)
    return at, lo, hi, phrase, context


def _parse(length: int, reach: int, size: int, contexts: bool = True):
    """``phrase, context, places``; without ``contexts`` how often each phrase of a batch occurs there (``phrase, n``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget(_powers)
        for whole in batches:
            for batch in text_batches(whole, "text", 4 * size):
                data, offsets = text_bytes(batch.column("text"))
                rids = batch.column("rid").to_numpy()
                found: list[tuple[np.ndarray, ...]] = []
                i = 0
                while i < len(rids):
                    j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
                    # a huge document goes in parts that share length - 1 bytes
                    for a in range(int(offsets[i]), max(int(offsets[i]) + 1, int(offsets[j]) - (length - 1 if j == i + 1 else 0)), size if j == i + 1 else 1 << 62):
                        z = min(int(offsets[j]), a + size + length - 1) if j == i + 1 else int(offsets[j])
                        inner = np.clip(offsets[i : j + 1], a, z) - a
                        ends = np.repeat(inner[1:], np.diff(inner))
                        at, lo, hi, phrase, context = triggers(data[a:z], ends, length, reach, contexts)
                        row = np.searchsorted(inner, lo, "right") - 1
                        base = np.maximum(a - offsets[i : j + 1], 0)[row] - inner[row]
                        found.append((rids[i + row], ((lo + base) << 18) | ((at - lo) << 10) | ((hi - lo) << 2), phrase, context))
                    i = j
                if not found:
                    continue
                rid, loc, phrase, context = (np.concatenate(x) for x in zip(*found, strict=True))
                if not len(rid):
                    continue
                if not contexts:
                    phrase, n = np.unique(phrase, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(phrase.view(np.int64)), pa.array(n)], ["phrase", "n"])
                    continue
                # equal contexts of a batch become one row with all their places
                order = np.lexsort((context, phrase))
                phrase, context = phrase[order], context[order]
                new = np.append(True, (phrase[1:] != phrase[:-1]) | (context[1:] != context[:-1]))
                places = np.empty((len(order), 2), np.int64)
                places[:, 0], places[:, 1] = rid[order], loc[order]
                bounds = np.append(np.flatnonzero(new), len(order)).astype(np.int32) * 16
                blob = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(places)])
                yield pa.RecordBatch.from_arrays([pa.array(phrase[new].view(np.int64)), pa.array(context[new].view(np.int64)), blob], ["phrase", "context", "places"])

    return run


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each place; the lowest two bits of ``loc`` say what is known: 1 repeated, 2 open, 3 repeated and a partner for open ones."""
    for batch in batches:
        blob = batch.column("places")
        bounds = np.frombuffer(blob.buffers()[1], np.int32)[blob.offset : blob.offset + len(blob) + 1]
        places = np.frombuffer(blob.buffers()[2], np.int64, (bounds[-1] - bounds[0]) // 8, int(bounds[0])).reshape(-1, 2)
        n = np.diff(bounds) // 16
        state = np.repeat(batch.column("state").to_numpy(), n)
        later = np.ones(len(state), bool)
        later[np.cumsum(n) - n] = False
        state = np.where(later & (state == 3), 1, state)  # one partner is enough
        yield pa.RecordBatch.from_arrays([pa.array(places[:, 0]), pa.array(places[:, 1] | state)], ["rid", "loc"])


def _contexts(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_batches(whole, "text"):
                data, offsets = text_bytes(batch.column("text"))
                locs = batch.column("locs")
                flat = locs.flatten().to_numpy()
                row = np.repeat(np.arange(len(locs)), np.diff(locs.offsets.to_numpy()))
                keep = (flat & 2) > 0
                flat, row = flat[keep], row[keep]
                lo, before, span = flat >> 18, (flat >> 10) & 255, (flat >> 2) & 255
                a = offsets[row] + lo
                size = span + length
                for k in range(0, len(row), 20_000):
                    s = slice(k, k + 20_000)
                    bounds = np.append(0, np.cumsum(size[s])).astype(np.int32)
                    bytes_ = data[np.repeat(a[s] - bounds[:-1], size[s]) + np.arange(bounds[-1])]
                    blob = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(bytes_)])
                    rid = pa.array(batch.column("rid").to_numpy()[row[s]])
                    yield pa.RecordBatch.from_arrays([rid, pa.array(lo[s]), pa.array(before[s].astype(np.int32)), pa.array((flat[s] & 1) == 0), blob], ["rid", "lo", "before", "open", "bytes"])

    return run


def corpus_order(right: np.ndarray, left: np.ndarray, before: np.ndarray, span: np.ndarray, length: int) -> np.ndarray:
    """For each context and each suffix length: is the string repeated among the contexts?

    ``right``: the ``length`` bytes from the trigger on; ``left``: the bytes
    before it, nearest first; ``before``: how many of these belong to the
    context; ``span``: its strings less one.
    """
    n, reach = left.shape
    order = np.argsort(np.ascontiguousarray(right).view(np.dtype((np.void, length))).ravel())
    right, left, before, span = right[order], left[order], before[order], span[order]
    common = np.full(n, -1, np.int64)  # with the one before it in order
    for k in range(0, n - 1, 4096):
        unequal = right[k + 1 : k + 4097] != right[k : min(k + 4096, n - 1)]
        common[k + 1 : k + 1 + len(unequal)] = np.where(unequal.any(1), unequal.argmax(1), length)
    repeated = np.zeros((n, reach + 1), bool)
    alive, names = np.arange(n), np.zeros(n, np.int64)
    for k in range(reach + 1):
        if k:  # one byte more of the dictionary suffix
            stay = before[alive] >= k
            alive, names = alive[stay], names[stay]
            if not len(alive):
                break
            names = np.unique(names * 256 + left[alive, k - 1], return_inverse=True)[1]
        valid = before[alive] - span[alive] <= k
        which = alive[valid]
        if len(which) < 2:
            continue
        group = np.cumsum(common < length - k)  # texts after the trigger that agree as far as the string goes
        _, inverse, count = np.unique(names[valid] * (n + 1) + group[which], return_inverse=True, return_counts=True)
        repeated[which[count[inverse] > 1], k] = True
    out = np.empty_like(repeated)
    out[order] = repeated
    return out


def _settle(length: int, reach: int, at_once: int = 20_000):
    def solve(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(rows).combine_chunks()
        if table.num_rows < 2:
            return
        blob = table.column("bytes").combine_chunks()
        if isinstance(blob, pa.ChunkedArray):
            blob = blob.chunk(0)
        bounds = np.frombuffer(blob.buffers()[1], np.int32)[blob.offset : blob.offset + len(blob) + 1].astype(np.int64)
        data = np.append(np.frombuffer(blob.buffers()[2], np.uint8), np.zeros(length + reach, np.uint8))
        before = table.column("before").to_numpy().astype(np.int64)
        size = np.diff(bounds)
        span = size - length
        at = bounds[:-1] + before
        steps = np.arange(length)
        right = data[at[:, None] + steps]
        right[steps >= (size - before)[:, None]] = 0
        back = np.arange(1, reach + 1)
        left = data[np.maximum(at[:, None] - back, 0)]
        repeated = corpus_order(right, left, before, span, length)
        open_ = table.column("open").to_numpy()
        rid, lo = table.column("rid").to_numpy(), table.column("lo").to_numpy()
        k, d = np.nonzero(repeated & open_[:, None])
        start = lo[k] + before[k] - d
        order = np.lexsort((start, rid[k]))
        r, s = rid[k][order], start[order]
        new = np.append(True, (r[1:] != r[:-1]) | (s[1:] > s[:-1] + 1)) if len(r) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        last = np.append(first[1:] - 1, len(r) - 1) if len(r) else first
        yield pa.RecordBatch.from_arrays([pa.array(r[first]), pa.array((s[first] << 31) | (s[last] + length))], ["rid", "span"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= at_once:
                keys = batch.column("key").to_numpy()
                cut = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
                if cut:
                    yield from solve([*held[:-1], batch.slice(0, cut)])
                    held = [batch.slice(cut)]
        if held:
            yield from solve(held)

    return run


def find_repeats(rows: DataFrame, length: int = 200, size: int = _BLOCK, hot: int = 50_000) -> tuple[DataFrame, DataFrame]:
    """For rows ``rid, doc_id, text``: (rid, doc_id, locs) of the settled contexts, and (rid, spans) of the open ones."""
    reach = (length - _WINDOW) // 2
    if reach < 2:
        raise ValueError("strings of less than 12 bytes have no triggers")
    texts = rows.select("rid", "text")
    # Phrases that occur once are out. Counts are summed before they are shuffled, and all joins here are between written
    # tables, or with one: a phrase that a third of all documents hold is split over tasks, never gathered in one.
    often = texts.mapInArrow(_parse(length, reach, size, contexts=False), "phrase long, n long").groupBy("phrase").agg(F.sum("n").alias("n"))
    often = materialise(often.where("n > 1").select("phrase"))
    parsed = texts.mapInArrow(_parse(length, reach, size), "phrase long, context long, places binary")
    parsed = materialise(parsed.join(often, "phrase", "left_semi"))
    mixed = materialise(parsed.groupBy("phrase").agg((F.min("context") != F.max("context")).alias("others")))
    equal = materialise(parsed.groupBy("phrase", "context").agg((F.sum(F.octet_length("places")) > 16).alias("twice")))
    near = parsed.join(mixed, "phrase").join(equal, ["phrase", "context"])
    state = F.when(F.col("twice"), F.when(F.col("others"), 3).otherwise(1)).when(F.col("others"), 2)
    known = near.select("places", state.cast("long").alias("state")).where("state is not null").mapInArrow(_unpack, "rid long, loc long")
    known = known.groupBy("rid").agg(F.collect_list("loc").alias("locs"))
    marks = materialise(rows.select("rid", "doc_id").join(known, "rid", "left"))

    some = marks.where(F.exists("locs", lambda x: x.bitwiseAND(2) > 0)).select("rid", "locs")
    edges = texts.join(some, "rid").select("rid", "text", "locs").mapInArrow(_contexts(length), "rid long, lo long, before int, open boolean, bytes binary")
    # what every string of a context holds after its trigger
    edges = edges.withColumn("key", F.xxhash64(F.substring("bytes", F.col("before") + 1, F.lit(length - reach + 1))))
    edges = materialise(edges)
    hot_keys = materialise(edges.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("key"))
    usual = edges
    more = None
    if not hot_keys.isEmpty():  # each string of a crowded key for itself, summed before the shuffle
        usual = edges.join(hot_keys, "key", "left_anti")
        every = edges.join(hot_keys, "key", "left_semi").select("rid", "lo", "open", F.posexplode(F.transform(F.sequence(F.lit(0), F.octet_length("bytes") - length), lambda k: F.sha2(F.substring("bytes", k + 1, F.lit(length)), 256))).alias("k", "name"))
        again = every.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name")
        more = every.where("open").join(again, "name", "left_semi").select("rid", (F.shiftleft(F.col("lo") + F.col("k"), 31) + F.col("lo") + F.col("k") + length).alias("span"))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spans = usual.repartition(n, "key").sortWithinPartitions("key").mapInArrow(_settle(length, reach), "rid long, span long")
    spans = spans.unionByName(more) if more is not None else spans
    return marks, spans.groupBy("rid").agg(F.collect_list("span").alias("spans"))


def _remove(length: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_batches(whole, "text"):
                data, offsets = text_bytes(batch.column("text"))
                sizes = np.diff(offsets)
                base = np.cumsum(sizes + 1) - sizes - 1  # a spare place after each row
                mark = np.zeros(int((sizes + 1).sum()), np.int32)
                for name in ("locs", "spans"):
                    lists = batch.column(name)
                    flat = lists.flatten().to_numpy(zero_copy_only=False)
                    counts = np.array([0 if x is None else x for x in pc.list_value_length(lists).to_pylist()], np.int64)
                    row = np.repeat(np.arange(len(lists)), counts)
                    if name == "locs":
                        keep = (flat & 1) == 1
                        flat, row = flat[keep], row[keep]
                        start = flat >> 18
                        end = start + ((flat >> 2) & 255) + length
                    else:
                        start, end = flat >> 31, flat & ((1 << 31) - 1)
                    np.add.at(mark, base[row] + start, 1)
                    np.add.at(mark, base[row] + end, -1)
                covered = np.cumsum(mark) > 0
                edge = np.diff(covered.astype(np.int8), prepend=0)
                starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                row = np.searchsorted(base, starts, "right") - 1
                starts, ends = starts - base[row], ends - base[row]
                dropped = np.zeros(len(sizes), np.int64)
                np.add.at(dropped, row, ends - starts)
                own = np.ones(len(covered), bool)
                own[base + sizes] = False
                kept = data[int(offsets[0]) : int(offsets[-1])][~covered[own]]
                bounds = np.append(0, np.cumsum(sizes - dropped)).astype(np.int32)
                blob = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(kept))])
                lists = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(row, np.arange(len(sizes) + 1)).astype(np.int32)), pa.StructArray.from_arrays([pa.array(starts), pa.array(ends)], ["start", "end"])
                )
                yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("doc_id"), pa.array(sizes), lists, blob], ["rid", "doc_id", "n_bytes", "removed", "kept"])

    return run, f"rid long, doc_id {kind}, n_bytes long, removed array<struct<start:long,end:long>>, kept binary"


def remove_repeats(docs: DataFrame, length: int = 200, size: int = _BLOCK, hot: int = 50_000) -> DataFrame:
    """One row per document: ``rid, doc_id, n_bytes, removed array<struct<start,end>>, kept binary``.

    Every byte covered by a string of ``length`` bytes that starts at another
    place too, in the same document or another, is removed; strings are
    compared on the input. Null texts count as empty; texts shorter than
    ``length`` stay whole; repeated rows are repeats of each other; null and
    repeated ids are allowed; other columns are not read. ``kept`` may end
    within a character. ``size`` bounds the bytes handled at once, ``hot``
    the left-over contexts of one key that are put in order in one task.
    """
    rows = text_rows(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    marks, spans = find_repeats(rows, length, size, hot)
    run, schema = _remove(length, kind)
    both = rows.select("rid", "text").join(marks, "rid").join(spans, "rid", "left")
    return both.select("rid", "doc_id", "text", "locs", "spans").mapInArrow(run, schema)


def clean_texts(docs: DataFrame, length: int = 200) -> DataFrame:
    """``docs`` with repeated strings cut out of ``text`` and, where there is one, ``n_chars`` set anew; all columns and rows stay.

    A character of which a part is cut goes as a whole; null texts stay null.
    """
    docs = settled(docs)
    rid = fresh(docs, "rid")
    cleaned = remove_repeats(docs, length).where(F.size("removed") > 0).select(F.col("rid").alias(rid), F.col("kept").alias(f"{rid}_kept"))
    text = F.when(F.col(f"{rid}_kept").isNotNull(), _whole_characters(F.col(f"{rid}_kept"))).otherwise(F.col("text"))
    out = with_row_ids(docs, rid).join(cleaned, rid, "left").withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(f"{rid}_kept").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*(quoted(c) for c in docs.columns))


@F.pandas_udf(StringType())
def _whole_characters(raw: pd.Series) -> pd.Series:
    return raw.map(lambda x: None if x is None else bytes(x).decode("utf-8", "ignore"))
