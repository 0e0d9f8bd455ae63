"""Exact, near and substring duplicates against brute force."""

import collections
import hashlib

import numpy as np
import pytest

from loomwright.llm import ngram_join, repeats
from loomwright.llm.exact_dedup import drop_duplicates, mark_duplicates
from loomwright.llm.queries import QUERIES


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(3)


@pytest.mark.parametrize("size,bits", [(4096, 64), (16, 64), (16, 3)])
def test_exact(spark, prose, size, bits):
    groups = collections.defaultdict(list)
    for k, t in enumerate(prose):
        groups[t].append(k)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in mark_duplicates(docs_of(spark, prose), size, bits).collect()}
    want = {k: (max(groups[t]), len(groups[t]), k == max(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for k, t in enumerate(prose)}
    assert got == want


def test_exact_edges(spark, odd_docs, odd_rows, no_docs):
    rows = mark_duplicates(odd_docs).collect()
    assert len(rows) == len(odd_rows)
    texts = collections.Counter(t or "" for _, t, *_ in odd_rows)
    assert sum(r.kept for r in rows) == len(texts)
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): n for t, n in texts.items()}
    assert all(r.group_size == by_hash[r.text_sha256] for r in rows)
    assert mark_duplicates(no_docs).count() == 0
    kept = drop_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == len(texts)


def brute_links(texts, threshold=0.8, n=5):
    sets = []
    for t in texts:
        w = (t or "").split()
        sets.append({tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set())
    links, root = [0] * len(sets), list(range(len(sets)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= threshold * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return [(k, top(k), links[k]) for k in range(len(sets))]


@pytest.mark.parametrize("block", [256, 5])
def test_jaccard(spark, prose, block):
    texts = [None, "", "a b", "a  b", *prose]
    for k in range(60):  # near copies with an edit or two
        words = prose[k % 9].split()
        words[(k * 7) % len(words)] = f"edit{k}"
        texts.append(" ".join(words))
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in ngram_join.jaccard_classes(docs_of(spark, texts), block=block).collect())
    assert got == brute_links(texts)


def test_jaccard_edges(spark, odd_docs, odd_rows, no_docs):
    assert ngram_join.jaccard_classes(odd_docs).count() == len(odd_rows)
    assert ngram_join.jaccard_classes(no_docs).count() == 0
    kept = ngram_join.keep_one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    # "a b" thrice and " a b c " twice are copies; texts without words stay
    assert kept.count() == len(odd_rows) - 3


def test_classes_do_not_meet_by_id(spark):
    """Classes of null-id rows alone, and classes that share a least doc_id, keep a row each."""
    texts = [" ".join(f"{c}{k}" for k in range(40)) for c in "abcdef"]
    near = [t.replace("39", "x") for t in texts]
    ids = [None, None, None, 7, 7, 7]
    rows = [(i, t) for i, t in zip(ids * 3, texts * 2 + near)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(3)
    kept = ngram_join.keep_one_of_each(docs).collect()
    assert sorted(r.text[0] for r in kept) == list("abcdef")
    classes = ngram_join.jaccard_classes(docs)
    assert classes.columns == ["rid", "doc_id", "class_id", "n_links"]
    assert {(r.doc_id, r.class_id, r.n_links) for r in classes.collect()} == {(None, None, 2), (7, 7, 2)}


def test_long_words(spark):
    """Words that differ only far inside, and blocks exchanged within a word, are other words."""
    a, b = "a" * 4096, "b" * 4096
    cjk, far = "\u65e5" * 4096, "\u672c" * 4096
    texts = [a + b, b + a, a + b, cjk + far, far + cjk, "x" * 20_000 + "y", "x" * 20_000 + "z", a + b + a, a + a + b]
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in ngram_join.jaccard_classes(docs_of(spark, texts)).collect())
    assert got == brute_links(texts)
    import pyarrow as pa

    from loomwright.llm.bytesets import word_hashes

    pick = np.random.default_rng(3)
    long = bytes(pick.integers(97, 123, 50_000).astype(np.uint8)).decode()
    words = [long]
    for _ in range(300):
        i, j = sorted(pick.integers(0, 50_000, 2).tolist())
        words.append(long[:i] + long[j] + long[i + 1 : j] + long[i] + long[j + 1 :])
    assert len(set(word_hashes(pa.array(words))[0].tolist())) == len(set(words))


def test_kept_rows_hold_for_other_splits(spark, prose, tmp_path):
    """Rows are told apart in the same way whatever the split of files when a step reads them again."""
    docs_of(spark, prose).repartition(9).write.parquet(f"{tmp_path}/t")
    docs = spark.read.parquet(f"{tmp_path}/t")

    def under(parts, make):
        spark.conf.set("spark.sql.files.minPartitionNum", parts)
        try:
            return make()
        finally:
            spark.conf.unset("spark.sql.files.minPartitionNum")

    for stage in (drop_duplicates, ngram_join.keep_one_of_each, repeats.clean_texts):
        lazy = under("2", lambda: stage(docs))  # its written steps under one split, its last step under another
        there = sorted(map(tuple, under("40", lazy.collect)))
        assert there == sorted(map(tuple, under("3", lambda: stage(docs).collect()))), stage.__name__
    assert sorted(r.text for r in under("40", under("2", lambda: drop_duplicates(docs)).collect)) == sorted(set(prose))


def test_bands():
    for recall in (0.9, 0.99, 0.9999):
        bands, rows = ngram_join.bands_for(0.8, recall)
        assert bands * rows <= 128 and 1 - (1 - 0.8**rows) ** bands >= recall


def brute_removed(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[k : k + length] for b in raw for k in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = True
        edge = np.diff(gone.astype(int), prepend=0)
        out.append((bytes(np.frombuffer(b, np.uint8)[~gone[:-1]]), list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))))
    return out


@pytest.mark.parametrize("length,size,hot", [(200, 1 << 20, 50_000), (200, 300, 50_000), (200, 1 << 20, 3), (40, 1 << 20, 50_000)])
def test_repeats(spark, prose, length, size, hot):
    texts = [None, "", "a" * 1000, "ab" * 400, "x" * 250, "x" * 180, "y" * 200, "y" * 201, *prose]
    got = {r.doc_id: (bytes(r.kept), [tuple(s) for s in r.removed]) for r in repeats.remove_repeats(docs_of(spark, texts), length, size, hot).collect()}
    assert [got[k] for k in range(len(texts))] == brute_removed(texts, length)


def test_repeats_edges(spark, odd_docs, odd_rows, no_docs):
    rows = repeats.remove_repeats(odd_docs).collect()
    want = collections.Counter(x[0] for x in brute_removed([r[1] for r in odd_rows], 200))
    assert collections.Counter(bytes(r.kept) for r in rows) == want
    assert repeats.remove_repeats(no_docs).count() == 0
    cleaned = repeats.clean_texts(odd_docs)
    assert cleaned.columns == odd_docs.columns and cleaned.count() == len(odd_rows)


def test_suffix_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    ids = sorted(texts)
    want = {}
    for k, (kept, spans) in zip(ids, brute_removed([texts[k] for k in ids], 200)):
        n = len(texts[k].encode())
        want[k] = (n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op8_suffix_dedup"](spark, sf).collect()} == want
