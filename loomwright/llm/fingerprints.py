"""Document fingerprints of improbable features, after the similarity digests of forensics.

Each 16-byte window has a collision entropy, from the number of pairs of
equal bytes in it. How often each entropy occurs in the corpus makes its
rarity. Of 32 windows in a row the rarest is marked (the first of equals);
windows marked 8 times or more are the features. A row may reach over the
ends of a text, where it is shorter, so that windows at the ends have as many
rows as others and a short text has features by the same rule. Hashes of the
features go, five bits each, into Bloom filters of 256 bytes; a filter with
160 features is followed by the next in the chain. Two chains are compared by
the overlap of bits beyond what chance gives, normalised to 0..1.
"""

from __future__ import annotations

import base64
import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwright.llm.bytesets import mix, text_batches, text_bytes
from loomwright.llm.common import ranked, text_rows

WINDOW = 16
RUN = 32
POPULAR = 8
PER_FILTER = 160
FILTER_BYTES = 256
_BITS = FILTER_BYTES * 8
_MOST_PAIRS = WINDOW * (WINDOW - 1) // 2
#: Windows with more pairs of equal bytes are runs of a few characters and carry nothing (under 2 bits of entropy).
_DULL = (WINDOW * WINDOW // 4 - WINDOW) // 2
_BLOCK = 1 << 16


def equal_pairs(b: np.ndarray) -> np.ndarray:
    """For each window of ``b`` the number of pairs of equal bytes in it."""
    n = len(b)
    if n < WINDOW:
        return np.zeros(0, np.int32)
    out = np.empty(n - WINDOW + 1, np.int32)
    for a in range(0, len(out), _BLOCK):
        part = b[a : min(n, a + _BLOCK + WINDOW - 1)]
        before, after = np.zeros(len(part), np.uint8), np.zeros(len(part), np.uint8)
        for d in range(1, WINDOW):
            same = (part[d:] == part[:-d]).view(np.uint8)
            before[d:] += same
            after[:-d] += same
        # pairs in the first window, then those that each step brings and takes
        first = 0
        for d in range(1, WINDOW):
            first += int(np.count_nonzero(part[d:WINDOW] == part[: WINDOW - d]))
        step = before[WINDOW:].astype(np.int32) - after[: len(part) - WINDOW]
        # a byte that enters is compared with the 63 before it, one that leaves with the 63 after it
        out[a : a + len(part) - WINDOW + 1] = first + np.append(0, np.cumsum(step))
    return out


def entropy_counts(docs: DataFrame) -> np.ndarray:
    """How many windows of the corpus have each number of equal pairs (a table of fixed size)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_MOST_PAIRS + 1, np.int64)
        for whole in batches:
            for batch in text_batches(whole, "text", 1 << 20):
                data, offsets = text_bytes(batch.column("text"))
                b = data[offsets[0] : offsets[-1]]
                if len(b) < WINDOW:
                    continue
                pairs = equal_pairs(b)
                ends = np.repeat(offsets[1:] - offsets[0], np.diff(offsets))[: len(pairs)]
                total += np.bincount(pairs[ends - np.arange(len(pairs)) >= WINDOW], minlength=_MOST_PAIRS + 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["pairs", "n"])

    rows = docs.select("text").mapInArrow(run, "pairs long, n long").groupBy("pairs").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(_MOST_PAIRS + 1, np.int64)
    for r in rows:
        out[r["pairs"]] = r["n"]
    return out


def rarity_ranks(counts: np.ndarray) -> np.ndarray:
    """Rank of each number of pairs, 0 for the rarest that occurs; dull windows have none (the largest value)."""
    order = np.lexsort((np.arange(len(counts)), np.where(counts > 0, counts, 0)))
    ranks = np.empty(len(counts), np.int64)
    ranks[order] = np.arange(len(counts))
    ranks[np.arange(len(counts)) > _DULL] = 0xFFFF
    return ranks


def features(b: np.ndarray, sizes: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``b``, number of its text) of each feature of the texts that stand one after another in ``b``."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    windows = np.maximum(sizes - WINDOW + 1, 0)
    if len(b) < WINDOW or not windows.any():
        return none
    # between the windows of two texts lie RUN - 1 places without one, so that a row never meets two texts
    base = np.cumsum(windows + RUN - 1) - windows
    own = np.repeat(np.arange(len(sizes)), windows)
    nth = np.arange(len(own)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = nth + np.repeat(np.cumsum(sizes) - sizes, windows)
    key = np.full(int((windows + RUN - 1).sum()) + RUN - 1, np.int64(0xFFFF) << 40)
    key += np.arange(len(key))
    key[base[own] + nth] = (ranks[equal_pairs(b)][at] << 40) | (base[own] + nth)
    wide = 1
    while wide < RUN:
        key = np.minimum(key[:-wide], key[wide:])
        wide *= 2
    chosen = key[key >> 40 < 0xFFFF] & ((1 << 40) - 1)
    starts = np.flatnonzero(np.append(True, chosen[1:] != chosen[:-1])) if len(chosen) else np.zeros(0, np.int64)
    marked = chosen[starts[np.diff(starts, append=len(chosen)) >= POPULAR]]
    text = np.searchsorted(base, marked, "right") - 1
    return marked - base[text] + (np.cumsum(sizes) - sizes)[text], text


def filters(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """The chain of each text: (filters, 32) arrays of 64-bit words, in order."""
    sizes = np.array([len(t) for t in texts], np.int64)
    b = np.frombuffer(b"".join(texts), np.uint8)
    own, hashes = [], []
    feature, text_of = features(b, sizes, ranks)
    if len(feature):
        words = np.ascontiguousarray(b[feature[:, None] + np.arange(WINDOW)]).view("<u8")
        h = np.full(len(feature), 0x243F6A8885A308D3, np.uint64)
        for k in range(words.shape[1]):
            h = mix(h * np.uint64(0x100000001B3) + words[:, k])
        own.append(text_of)
        hashes.append(h)
    have = np.concatenate(own) if own else np.zeros(0, np.int64)
    lone = np.setdiff1d(np.flatnonzero(sizes > 0), have)  # short or dull: the text itself is the feature
    if len(lone):
        import xxhash

        have = np.append(have, lone)
        hashes.append(np.array([xxhash.xxh3_64_intdigest(texts[k]) for k in lone.tolist()], np.uint64))
    if not len(have):
        return [np.zeros((0, _BITS // 64), np.uint64)] * len(texts)
    h = np.concatenate(hashes)
    order = np.argsort(have, kind="stable")
    have, h = have[order], h[order]
    count = np.bincount(have, minlength=len(texts))
    place = np.arange(len(have)) - np.repeat(np.cumsum(count) - count, count)
    chain = -(-count // PER_FILTER)
    base = np.cumsum(chain) - chain
    row = base[have] + place // PER_FILTER
    bits = np.zeros((int(chain.sum()), _BITS), np.uint8)
    for k in range(5):
        bits[row, ((h >> np.uint64(11 * k)) & np.uint64(_BITS - 1)).astype(np.int64)] = 1
    packed = np.packbits(bits, axis=1).view(np.uint64)
    return [packed[s : s + c] for s, c in zip(base.tolist(), chain.tolist(), strict=True)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Overlap of two chains from 0 to 1: for each filter of the shorter chain its best partner, by set bits weighted."""
    if a.shape == b.shape and np.array_equal(a, b):
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    na, nb = np.bitwise_count(a).sum(1).astype(float), np.bitwise_count(b).sum(1).astype(float)
    both = np.array([np.bitwise_count(x & b).sum(1) for x in a], float)
    least = np.minimum(na[:, None], nb)
    chance = na[:, None] * nb / _BITS
    score = np.clip((both - chance) / np.maximum(least - chance, 1e-9), 0, 1).max(1)
    return float(min(1.0, (score * na).sum() / na.sum()))


def text_of(chain: np.ndarray) -> str:
    return base64.b64encode(chain.tobytes()).decode()


def _groups(rows: DataFrame, n: int) -> DataFrame:
    """``rows`` (rid, doc_id, text) with ``group, tail, h``: runs of the order as even as ranks make them, each followed by the row after it (tail 1).

    The order is by falling doc_id (nulls last), then by a hash of the text,
    then by row; only the first key of each run, one for each partition, is
    gathered.
    """
    keys = rows.select("rid", "doc_id", F.xxhash64("text").alias("h"))
    places = ranked(keys, [F.col("doc_id").desc_nulls_last(), F.col("h"), F.col("rid")], "place")
    total = places.count()
    starts = sorted({total * k // n for k in range(n)}) if total else [0]
    heads = {r["place"]: (r["doc_id"], r["h"], r["rid"]) for r in places.where(F.col("place").isin(starts)).collect()}
    cuts = rows.sparkSession.sparkContext.broadcast([heads[k] for k in sorted(heads)])

    @F.pandas_udf("array<int>")
    def roles(doc_id: pd.Series, missing: pd.Series, h: pd.Series, rid: pd.Series) -> pd.Series:
        """The row's group; where it is the first of it, also the group before, which it follows."""
        known = [c for c in cuts.value if c[0] is not None]
        rest = [c[1:] for c in cuts.value if c[0] is None]
        ids = sorted({c[0] for c in known})
        below = [sum(c[0] > x for c in known) for x in ids]  # cuts before those of each id
        of = {x: [c[1:] for c in known if c[0] == x] for x in ids}
        missing = missing.to_numpy(bool)
        values = doc_id[~missing]
        at = np.searchsorted(np.array(ids, dtype=object if values.dtype == object else values.dtype), values.to_numpy(), "left") if ids else np.zeros(len(values), np.int64)
        out, k = [], 0
        for gone, x, *key in zip(missing.tolist(), doc_id.tolist(), h.tolist(), rid.tolist(), strict=True):
            if gone:
                before, ties = len(known), rest
            else:
                p = int(at[k])
                k += 1
                same = p < len(ids) and ids[p] == x
                before = below[p] if p < len(ids) else 0
                if not same:
                    out.append([before + (len(of[ids[p]]) if p < len(ids) else 0) - 1])
                    continue
                ties = of[x]
            place = bisect.bisect_right(ties, tuple(key))
            group = before + place - 1
            first = place > 0 and ties[place - 1] == tuple(key)
            out.append([group, (group - 1) % len(cuts.value)] if first else [group])
        return pd.Series(out)

    # ids of no value go as one that has, beside the mark that they have none: pandas would turn whole numbers into floats
    filled = F.coalesce("doc_id", F.lit(next((c[0] for c in cuts.value if c[0] is not None), None)).cast(rows.schema["doc_id"].dataType))
    dealt = rows.withColumn("h", F.xxhash64("text")).select("*", F.posexplode(roles(filled, F.isnull("doc_id"), "h", "rid")).alias("tail", "group"))
    return dealt.repartitionById(n, F.col("group")) if hasattr(dealt, "repartitionById") else dealt.repartition(n, "group")


def compare_edited(docs: DataFrame, counts: np.ndarray | None = None) -> DataFrame:
    """Fingerprints of each whole text and of its edited text, and how like they are.

    Rows: ``doc_id, n_chars, edited, fingerprint, edited_fingerprint,
    near_edited, near_next``. The edited text has the last floor(n_chars/2)
    code points replaced by the first as many (or all) of the next
    document's, in descending order of doc_id; after the last comes the
    first again. Null texts count as empty, with an empty fingerprint; null
    ids come last; rows that share an id are ordered by a hash of their
    texts, and split over tasks like others. A text without features (under
    16 bytes, or of few characters) has itself as its feature. Equal
    fingerprints have likeness 1, an empty one 0 to others. Ids may be of
    any type with an order. Other columns are not read.
    """
    spark = docs.sparkSession
    counts = entropy_counts(docs) if counts is None else counts
    ranks = spark.sparkContext.broadcast(rarity_ranks(counts))
    kind = docs.schema["doc_id"].dataType.simpleString()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = _groups(text_rows(docs), n).sortWithinPartitions("group", "tail", F.col("doc_id").desc_nulls_last(), "h", "rid").select("group", "tail", "doc_id", "text")

    def flush(held: list[tuple], following: str) -> pa.RecordBatch:
        texts = [h[1] for h in held]
        after = [*texts[1:], following]
        edited = [t[: len(t) - len(t) // 2] + x[: len(t) // 2] for t, x in zip(texts, after, strict=True)]
        chains = filters([t.encode() for t in [*texts, following]], ranks.value)
        changed = filters([t.encode() for t in edited], ranks.value)
        cols = [
            pa.array([h[0] for h in held], id_type),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array(edited, pa.string()),
            pa.array([text_of(c) for c in chains[:-1]], pa.string()),
            pa.array([text_of(c) for c in changed], pa.string()),
            pa.array([likeness(a, b) for a, b in zip(chains[:-1], changed, strict=True)], pa.float64()),
            pa.array([likeness(a, b) for a, b in zip(chains[:-1], chains[1:], strict=True)], pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(cols, ["doc_id", "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(docs.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now, size, closed = None, 0, False
        for whole in batches:
            for batch in text_batches(whole, "text", 4 << 20):
                columns = (batch.column(c).to_pylist() for c in ("group", "tail", "doc_id", "text"))
                for g, tail, doc_id, text in zip(*columns, strict=True):
                    if g != now:
                        now, closed = g, False
                    if tail:
                        if held and not closed:
                            yield flush(held, text)
                            held, size = [], 0
                        closed = True
                        continue
                    if size + len(text) > 1 << 20 and held:
                        yield flush(held, text)
                        held, size = [], 0
                    held.append((doc_id, text))
                    size += len(text)

    return dealt.mapInArrow(run, f"doc_id {kind}, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
