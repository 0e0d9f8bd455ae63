"""Token alignment against a plain recomputation with the libraries."""

import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from loomwright.llm.alignment import align_tokens, byte_letters, plain_counter
from loomwright.llm.queries import QUERIES, tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=B)


def spans(pieces):
    out, at = [], 0
    for i, raw in pieces:
        out.append((at, at + len(raw), i))
        at += len(raw)
    return out


def plain(texts, libraries):
    """Every document token by token, every pair of tokens compared."""
    t, sp = libraries
    letters = byte_letters()
    docs, corpus = [], Counter()
    for text in texts:
        want = b" " + (text or "").encode()
        a = [(i, bytes(letters[c] for c in t.id_to_token(i))) for i in t.encode(want.decode(), add_special_tokens=False).ids]
        b = []
        for i in sp.encode(text or ""):
            piece = sp.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else piece.replace("▁", " ").encode()))
        if not text or b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            docs.append(None)
            continue
        a, b = spans(a), spans(b)
        links = [(x[2], y[2]) for x in a for y in b if x[0] < y[1] and y[0] < x[1]] if len(a) < 400 else sweep(a, b)
        cuts = sorted({x[1] for x in a} & {y[1] for y in b})
        groups, at = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(x[2]) for x in side if at < x[1] <= cut) for side in (a, b)))
            at = cut
        docs.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        corpus.update(set(links))
    top = Counter()
    for (x, _), n in corpus.items():
        top[x] = max(top[x], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, n_groups, links, digest = d
            out.append((n_a, n_b, n_groups, len(links), sum(corpus[p] == top[p[0]] for p in links), sum(corpus[p] for p in links), digest))
    return out


def sweep(a, b):
    out, j = [], 0
    for x in a:
        while b[j][1] <= x[0]:
            j += 1
        k = j
        while k < len(b) and b[k][0] < x[1]:
            out.append((x[2], b[k][2]))
            k += 1
    return out


def columns(df, *more):
    return sorted(tuple(map(str, r)) for r in df.select(*more, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())


def test_all_documents_equal_a_plain_recomputation(spark, sf, libraries):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").toPandas()
    docs = docs[docs.text.str.len() < 6000]
    want = [tuple(map(str, (i, *w))) for i, w in zip(docs.doc_id, plain(docs.text, libraries), strict=True)]
    got = align_tokens(spark.createDataFrame(docs).repartition(3), A, B, size=50_000)
    assert columns(got, "doc_id") == sorted(want)
    whole = QUERIES["op12_token_alignment"](spark, sf)
    assert whole.count() == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_odd_texts(spark, odd_docs, odd_rows, no_docs, libraries):
    got = align_tokens(odd_docs, A, B)
    want = plain([r[1] for r in odd_rows], libraries)
    assert columns(got, "doc_id") == sorted(tuple(map(str, (r[0], *w))) for r, w in zip(odd_rows, want, strict=True))
    assert align_tokens(no_docs, A, B).count() == 0
    assert got.columns[0] == "doc_id"


def test_scrambled_texts_in_any_slices(spark, libraries):
    pick = random.Random(5)
    parts = ["a", "b", " ", "\n", "é", "▁", "\U0001f9ff", "the", "ing", "\t", "  ", "=", "<s>", "<0x0A>", "<|endoftext|>", "ﬁ", "　"]
    texts = ["".join(pick.choices(parts, k=pick.randint(1, 40))) for _ in range(300)]
    docs = spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)], "doc_id string, text string")
    want = sorted(tuple(map(str, (k, *w))) for k, w in enumerate(plain(texts, libraries)))
    assert columns(align_tokens(docs.repartition(4), A, B, size=300), "doc_id") == want
    assert columns(align_tokens(docs.coalesce(1), A, B), "doc_id") == want


def test_special_strings_are_plain_text(libraries):
    texts = ["<|endoftext|>", "a <|endoftext|> b", "x<|endoftext|>" * 40, "<|endo ftext|>"]
    ids, bounds = plain_counter(A).encode(pa.array(texts))
    assert [ids[x:y].tolist() for x, y in zip(bounds[:-1], bounds[1:])] == [libraries[0].encode(t, add_special_tokens=False).ids for t in texts]
