"""SentencePiece codec, token counts and packing against the libraries."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from loomwright.llm.bytesets import UnitCache
from loomwright.llm.packing import best_fit, pack, pack_documents, token_pieces
from loomwright.llm.piece_codec import MergeVocabulary, encode_texts
from loomwright.llm.queries import QUERIES, tokenizer_path
from loomwright.llm.token_counts import Counter, count_tokens

PIECES = tokenizer_path("piece_bpe_32k.model")


def scrambled(n, parts, seed=1):
    pick = random.Random(seed)
    return ["".join(pick.choices(parts, k=pick.randint(1, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def vocab():
    return MergeVocabulary(PIECES)


def test_ids_and_texts_equal_the_library(vocab):
    texts = [None, "", " ", "x" * 300, *scrambled(800, ["a", "b", " ", "\n", "é", "▁", "\U0001f9ff", "the", "ing", "\t", "  ", "=", "<s>", "<0x0A>"])]
    ids, bounds = vocab.encode(pa.array(texts))
    want = vocab.library.encode([t or "" for t in texts], add_eos=True)
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == want
    assert vocab.decode(ids, bounds) == vocab.library.decode(want)


@pytest.mark.parametrize("lines,letters", [(29_000, 70), (20_000, 100)])
def test_a_block_of_long_units(lines, letters):
    """15,000 units of over 70 characters have more symbols than one agenda has places."""
    vocab, pick = MergeVocabulary(PIECES), random.Random(8)
    text = "\n".join("".join(pick.choices("ACGTacgt", k=letters)) for _ in range(lines))
    ids, _ = vocab.encode(pa.array([text]), end=False)
    assert ids.tolist() == vocab.library.encode(text)


def test_one_whole_text_of_each_batch_is_checked(spark, monkeypatch, vocab):
    """An empty or very long first text does not take the place of the one that is checked."""
    from loomwright.llm import piece_codec

    docs = spark.createDataFrame([(0, None), (1, "a\n" * (1 << 19)), (2, "short text")], "doc_id long, text string").coalesce(1)
    seen = []

    class Library:
        def encode(self, text, **more):
            if isinstance(text, str):
                seen.append(text)
            return vocab.library.encode(text, **more)

    proxy = MergeVocabulary(PIECES)
    proxy.library = Library()
    monkeypatch.setitem(piece_codec._loaded, PIECES, proxy)
    plan = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: plan.append(run))
    encode_texts(docs, PIECES)
    table = pa.table({"doc_id": [0, 1, 2], "text": pa.array([None, "a\n" * (1 << 19), "short text"])})
    out = list(plan[0](iter(table.to_batches())))
    assert seen == ["short text"] and sum(b.num_rows for b in out) == 3


def test_decode_of_any_ids(vocab):
    pick = random.Random(3)
    runs = [[pick.choice([pick.randrange(3, 32000), pick.randrange(3, 259)]) for _ in range(pick.randint(1, 12))] for _ in range(500)]
    flat, bounds = np.array([i for r in runs for i in r]), np.append(0, np.cumsum([len(r) for r in runs]))
    assert vocab.decode(flat, bounds) == vocab.library.decode(runs)


def test_codec_query(spark, odd_docs, odd_rows, no_docs, vocab):
    got = sorted(((r.doc_id, r.ids, r.decoded) for r in encode_texts(odd_docs, PIECES).collect()), key=str)
    want = [(d, vocab.library.encode(t or "", add_eos=True)) for d, t, *_ in odd_rows]
    assert got == sorted(((d, i, vocab.library.decode(i)) for d, i in want), key=str)
    assert encode_texts(no_docs, PIECES).count() == 0


def test_codec_digests(spark, sf, vocab):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op1_piece_codec"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = vocab.library.encode(texts[r.doc_id], add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(vocab.library.decode(ids).encode()).hexdigest()


PARTS = ["a", "b", " ", "\n", "é", "　", "\U0001f9ff", "the", "ing", "\t", "  ", "'s", "<|endoftext|>", "<|endo", "ftext|>", "̈", "\x1c", "Σ", "12", "..."]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_units_equal_whole_texts(name):
    tokens = Counter(tokenizer_path(name))
    texts = [None, "", *scrambled(1500, PARTS)]
    for chunk in (1 << 16, 40):
        ids, bounds = tokens.encode(pa.array(texts), chunk)
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == tokens.encode_whole([t or "" for t in texts])


@pytest.mark.parametrize("chunk,overlap", [(30, 5), (60, 40), (200, 8)])
def test_spliced_chunks_equal_whole_texts(chunk, overlap):
    tokens = Counter(tokenizer_path("byte_bpe_50k.json"))
    for text in [*scrambled(400, PARTS, 5), "a" * 700, " " * 500, "ab" * 300 + " c" * 200]:
        assert tokens.encode_huge(text, chunk, overlap).tolist() == tokens.encode_whole([text])[0]


WIDE = ["\x85", "\xa0", "\u1680", *map(chr, range(0x2000, 0x200B)), "\u2028", "\u2029", "\u202f", "\u205f", "\u3000"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_runs_of_mixed_white_space(name):
    tokens = Counter(tokenizer_path(name))
    mixed = ["a \xa0 \xa0 b", "a\xa0 \xa0 \xa0 \xa0 b", *scrambled(800, ["\xa0", " ", "\xa0 ", "\n", "a", "é", "—"], 3), *scrambled(800, [*WIDE, " ", " ", " ", "\t", "\n", "b", "\u200b", "à"], 4)]
    texts = [*mixed, "word \xa0 \xa0 " * 5900, "word \xa0 \xa0 " * 6000, "é\u3000 \xa0 x" * 6000]  # on both sides of 65,536 bytes
    assert {len(t.encode()) > 1 << 16 for t in texts[-3:-1]} == {True, False}
    for chunk in (1 << 16, 40):
        ids, bounds = tokens.encode(pa.array(texts), chunk)
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == tokens.encode_whole(texts)


def test_white_space_of_the_pattern():
    """The characters that a run of white space of the vocabulary's pattern holds are those that allow no cut after them."""
    from loomwright.llm.bytesets import spaced_starts

    pre = Counter(tokenizer_path("byte_bpe_50k.json")).tokenizer.pre_tokenizer
    every = [chr(c) for c in range(128, 0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3100 or c % 97 == 0)]
    text = "".join(f"a{c}  " for c in every) + "a"
    cuts = spaced_starts(np.frombuffer(text.encode(), np.uint8))
    edges = {e for _, (_, e) in pre.pre_tokenize_str(text)}  # in characters
    at = np.cumsum([0, *(len(c.encode()) for c in text)])
    own = [4 * k + 2 for k in range(len(every))]  # before the white space after each character
    assert [c for c, p in zip(every, own) if p not in edges] == [c for c, p in zip(every, own) if not cuts[at[p]]] == WIDE


def test_counts(spark, odd_docs, odd_rows, no_docs):
    tokens = Counter(tokenizer_path("byte_bpe_50k.json"))
    got = sorted((tuple(r) for r in count_tokens(odd_docs, tokenizer_path("byte_bpe_50k.json")).collect()), key=str)
    sizes = [len(tokens.encode_whole([t or ""])[0]) for _, t, *_ in odd_rows]
    assert got == sorted(((r[0], len((r[1] or "").encode()), n, n > 512) for r, n in zip(odd_rows, sizes)), key=str)
    assert count_tokens(no_docs, tokenizer_path("byte_bpe_50k.json")).count() == 0
    pieces = {r.doc_id: r.n_tokens for r in count_tokens(odd_docs, PIECES).collect() if r.doc_id is not None}
    assert pieces[1] == 0 and pieces[3] > 0


def held(rows, capacity):
    """Every sequence is gapless from 0 and within the capacity; returns how many there are."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing(spark, odd_docs, odd_rows, no_docs):
    path = tokenizer_path("word_bpe_49k.json")
    tokens = Counter(path)
    for capacity in (16, 4096):
        rows = pack_documents(odd_docs, path, capacity).collect()
        whole = defaultdict(list)
        for r in rows:
            whole[r.doc_id].append(r)
            assert len(r.ids) == 4 * r.length and r.start == r.piece * capacity
        for doc_id, text, *_ in odd_rows[:13]:
            parts = sorted({(r.start, bytes(r.ids)) for r in whole[doc_id]})
            assert np.frombuffer(b"".join(x for _, x in parts), "<u4").tolist() == [*tokens.encode_whole([text or ""])[0], 1]
        n = held(rows, capacity)
        assert n <= 1.25 * -(-sum(r.length for r in rows) // capacity) + 1
    assert pack_documents(no_docs, path).count() == 0
    digests = pack_documents(odd_docs, path, with_ids=False).collect()
    by_id = {(r.doc_id, r.piece): r for r in token_pieces(odd_docs, path).collect()}
    assert all(r.ids_crc32 == zlib.crc32(by_id[r.doc_id, r.piece].ids) for r in digests if r.doc_id is not None)


def test_best_fit_is_tight():
    pick = random.Random(2)
    for _ in range(30):
        counts = defaultdict(int)
        for _ in range(400):
            counts[pick.randint(1, 60)] += 1
        ranks, firsts, offsets = best_fit(dict(counts), 100)
        lengths = [n for n in sorted(counts, reverse=True) for _ in range(counts[n])]
        bins = defaultdict(list)
        for rank, length in enumerate(lengths):
            k = np.searchsorted(ranks, rank, "right") - 1
            bins[firsts[k] + rank - ranks[k]].append((offsets[k], length))
        for parts in bins.values():
            parts.sort()
            assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
            assert sum(n for _, n in parts) <= 100
        assert len(bins) <= 1.05 * sum(lengths) / 100 + 1


def naive_best_fit(lengths, capacity):
    """How many sequences the pieces take, the longest first, each into the fullest sequence that has room for it."""
    room = []
    for length in sorted(lengths, reverse=True):
        fits = [k for k, r in enumerate(room) if r >= length]
        if fits:
            room[min(fits, key=lambda k: room[k])] -= length
        else:
            room.append(capacity - length)
    return len(room), sorted(room)


def test_best_fit_is_that_of_single_pieces():
    pick = random.Random(6)
    for capacity in (7, 30, 100):
        for _ in range(40):
            counts = defaultdict(int)
            for _ in range(pick.randint(1, 120)):
                counts[pick.randint(1, capacity)] += 1
            ranks, firsts, offsets = best_fit(dict(counts), capacity)
            lengths = [n for n in sorted(counts, reverse=True) for _ in range(counts[n])]
            filled = defaultdict(int)
            for rank, length in enumerate(lengths):
                k = np.searchsorted(ranks, rank, "right") - 1
                filled[firsts[k] + rank - ranks[k]] += length
            assert (len(filled), sorted(capacity - x for x in filled.values())) == naive_best_fit(lengths, capacity)


def test_pack_keeps_columns_of_any_name(spark):
    names = ["doc_id", "piece", "length", "_rank", "_place", "_first", "_length", "_from", "_to", "_at", "_p", "_part", "_start", "a.b"]
    pieces = spark.createDataFrame([(k, 0, 1 + k % 5, *range(11)) for k in range(40)], ", ".join(f"`{n}` long" for n in names))
    rows = pack(pieces, 5)
    assert rows.columns == [*names, "sequence_id", "offset"]
    assert held(rows.collect(), 5) == 24


def test_unit_cache_compares_bytes():
    cache = UnitCache(5)
    flat = lambda xs: np.frombuffer(b"".join(xs), np.uint8)
    sizes = lambda xs: np.array([len(x) for x in xs])
    h = np.array([1 << 60, 1 << 60, 5, 6], np.uint64)
    units = [b"ab", b"cd", b"", b"x" * 70]
    cache.add(h, flat(units), sizes(units), np.arange(8, dtype=np.int32), np.array([2, 2, 2, 2]))
    assert cache.n == 1  # one of each hash, nothing empty, nothing long
    assert cache.find(h, flat(units), sizes(units)).tolist() == [0, -1, -1, -1]
    many = [b"u%d" % k for k in range(4000)]
    big = UnitCache(3000)
    hashes = np.random.default_rng(1).integers(0, 2**63, 4000, dtype=np.uint64)
    for k in range(0, 4000, 500):
        s = slice(k, k + 500)
        big.add(hashes[s], flat(many[s]), sizes(many[s]), np.arange(k, k + 500, dtype=np.int32), np.ones(500, np.int64))
    found = big.find(hashes, flat(many), sizes(many))
    assert big.n == 3000 and (found >= 0).sum() == 3000 and (big.ids[big.start[found[found >= 0], 1]] == np.flatnonzero(found >= 0)).all()


def test_words_that_hold_the_separator():
    tokens = Counter(tokenizer_path("word_bpe_49k.json"))
    assert tokens.apart
    texts = ["a ~ b~c ~~ d", "~", "x~", *scrambled(500, ["~", " ", "a", "|", "^", "é", " "], 9), *["w%d~ v" % k for k in range(9000)]]
    ids, bounds = tokens.encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == tokens.encode_whole(texts)


def test_words_share_units_whatever_their_marks_and_capitals():
    tokens = Counter(tokenizer_path("word_bpe_49k.json"))
    texts = ["Word, word. word, WORD. (Word) wORD) 7word's Word7", "H̱ ẖ J̌ ≮ i̇ İ 1⃣", "don't DON'T 'safe \"'s '7 ''ll 12'34", "a<|endoftext|>b <|EndOfText|>, <|x|>"]
    texts += scrambled(300, ["'", "s", "S", "ll", "H", "J", "=", "7", ".", " ", "\u0338", "\u0331", "\u030c", "é", "word"], 3)
    assert tokens.encode(pa.array(texts[:1]))[0].tolist() == tokens.encode_whole(texts[:1])[0]
    assert tokens.cache.n == 7  # word , . ( ) 7 's: eight words were eight units before
    for some in (texts[:3], texts[3:4], texts):
        ids, bounds = tokens.encode(pa.array(some))
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == tokens.encode_whole(some)
