"""Ranked lexical search against a plain scoring of all documents."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from loomwright.llm import lexical_search
from loomwright.llm.bytesets import mix
from loomwright.llm.lexical_search import QueryTerms, contributions, search, terms_of

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, top=10):
    """Every document scored for every item."""
    held = [(i, Counter(words(t))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in held:
            n, score = sum(c.values()), 0
            for t in set(words(text)):
                if t in c:
                    m = 100 - 90 + (90 * n * n_docs) // total
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, k + 1, s[2], -s[0]) for k, s in enumerate(scored[:top])]
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("window,size,parts", [(4096, 8 << 20, 1), (8, 2000, 3), (3, 100, 5)])
def test_equal_to_a_plain_scoring(spark, prose, window, size, parts):
    docs = [(k * 7 % 1000, t) for k, t in enumerate([*prose, *prose[:20], None, "", "..."])]
    items = [*((k, t) for k, t in enumerate(prose[:25])), (90, None), (91, ""), (92, "nowhere"), (93, "W1 w2, w2")]
    d, q = frames(spark, docs, items)
    got = search(d.repartition(parts), q, window=window, size=size)
    assert rows_of(got) == plain(docs, items)
    assert dict(got.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}


def test_blocks_of_items_change_nothing(spark, prose):
    docs, items = list(enumerate(prose)), list(enumerate(prose[:30]))
    d, q = frames(spark, docs, items)
    assert rows_of(search(d, q, block_terms=600)) == plain(docs, items)


def test_ties_repeated_rows_and_null_ids(spark):
    docs = [(None, "a b"), (5, "a b"), (3, "a b"), (3, "a b"), *((k, "a c") for k in range(40, 10, -1))]
    items = [(1, "a b"), (1, "a b"), (None, "c"), (2, "c!a?")]
    d, q = frames(spark, docs, items)
    assert rows_of(search(d.repartition(4), q, window=2)) == plain(docs, items)


def test_odd_texts_and_empty_tables(spark, odd_docs, odd_rows, no_docs):
    items = [(k, t) for k, t in enumerate(["a", "b y", "é 　", "日本 ▁a▁", None])]
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as rank", "2 as score")
    assert rows_of(search(odd_docs, q)) == plain([(r[0], r[1]) for r in odd_rows], items)
    assert search(no_docs, q).count() == 0
    assert search(odd_docs, q.limit(0)).count() == 0
    assert search(odd_docs, q.where("item_id = 4")).columns == ["item_id", "rank", "doc_id", "score"]


def test_terms_and_lengths_of_a_text_over_blocks(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(lexical_search, "BLOCK", 50)
    texts = ["Ab-c é\x00D " * 30, None, "", "x" * 200, "　. "]
    assert [[t.decode() for t in x] for x in terms_of(pa.array(texts))] == [words(t) for t in texts]


def test_terms_that_share_a_hash(monkeypatch):
    """Equal hashes are told apart by bytes."""
    from loomwright.llm.bytesets import Units, word_starts

    monkeypatch.setattr(Units, "hashes", lambda self: mix(np.ones(len(self.at), np.uint64)))
    u = Units(np.frombuffer(b"aa bb cc aa dd bb", np.uint8), np.zeros(1, np.int64), word_starts, True)
    at, number = QueryTerms([b"aa", b"bb", b"zz"]).find(u)
    assert list(zip(at.tolist(), number.tolist())) == [(0, 0), (1, 1), (3, 0), (5, 1)]


def test_products_beyond_64_bits():
    n, n_docs = np.array([10**7, 5]), 3 * 10**11
    got = contributions(7, np.array([3, 1]), n, n_docs, 10**14)
    want = [7 * (10**9 * t // (1000 * t + 8 * (10 + 90 * x * n_docs // 10**14))) for t, x in ((3, 10**7), (1, 5))]
    assert got.tolist() == want
