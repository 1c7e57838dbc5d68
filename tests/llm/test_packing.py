from __future__ import annotations

import random
import time
import tracemalloc
import zlib

import numpy as np
import pytest
from public_tokenizers import path as tokenizer_path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm_fixtures import edge_docs, folder, no_docs  # noqa: F401
from ledgerloom.llm import packing, registry
from ledgerloom.llm.common import table

PATH = tokenizer_path(registry.TOKENIZER)


@pytest.fixture(scope="module")
def tokenizer():
    out = Tokenizer.from_file(PATH)
    out.encode_special_tokens = True
    return out


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [registry.END_ID]


def holds(pieces, docs, tokenizer, window):
    """Every id in one piece, gapless offsets, and no padding."""
    by_doc: dict = {}
    sequences: dict[int, list] = {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for doc_id, texts in docs.items():
        want = sorted(ids_of(tokenizer, t) for t in texts)
        total = sum(map(len, want))
        assert sum(p.length for p in by_doc[doc_id]) == total
        if len(texts) == 1:
            at, joined = 0, []
            for p in sorted(by_doc[doc_id], key=lambda p: p.start):
                assert p.start == at and p.length > 0 and p.doc_tokens == total
                joined += np.frombuffer(p.ids, "<u4").tolist()
                at += p.length
            assert joined == want[0]
    assert by_doc.keys() == docs.keys()
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window and (at == window or at & (at - 1) == 0)


def test_words_encode_like_the_whole_text(tokenizer):
    random.seed(9)
    odd = list("aAbZ éÉßΣσςİ.,'!*#& \n\t\x0b\x1c\x85\u3000éñ½²漢ﾞ😀12") + [
        "<|endoftext|>", "'s", "'ll ", "ΟΔΟΣ.", "é!", "क़!", "각.",
    ]
    encoder = packing.Encoder(PATH)
    for _ in range(3000):
        text = "".join(random.choices(odd, k=random.randint(0, 14)))
        got = encoder.ids([text])[0].tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("window,shard", [(64, 200), (4096, 1 << 21)])
def test_edges(spark, scratch, tokenizer, edge_docs, monkeypatch, window, shard):
    monkeypatch.setattr(packing, "SHARD_TOKENS", shard)
    docs: dict = {}
    for doc_id, text in edge_docs.select("doc_id", "text").collect():
        docs.setdefault(doc_id, []).append(text)
    out = packing.packed(edge_docs, PATH, registry.END_ID, scratch.keep, window).collect()
    holds(out, docs, tokenizer, window)


def test_given_documents(spark, folder, tokenizer):
    docs = table(spark, folder, "documents")
    want = {r.doc_id: ids_of(tokenizer, r.text) for r in docs.collect()}
    out = registry.op10_packing(spark, folder).collect()
    for p in out:
        ids = np.array(want[p.doc_id][p.start : p.start + p.length], "<u4")
        assert p.ids_crc32 == zlib.crc32(ids.tobytes()) and p.doc_tokens == len(want[p.doc_id])
    assert sum(p.length for p in out) == sum(map(len, want.values()))


def test_neighbours_by_brute_force():
    rng = np.random.default_rng(10)
    pieces = [rng.integers(0, 60, rng.integers(3, 40)).astype("<u4") for _ in range(50)]
    idf = rng.random(60).astype(np.float32) + 0.1
    index = packing.ShardIndex(pieces, idf, 20.0)
    unused = rng.random(50) < 0.7

    def weight(term, piece):
        tf = int((piece == term).sum())
        norm = packing.K1 * (1 - packing.B + packing.B * len(piece) / 20.0)
        return float(idf[term]) * tf * (packing.K1 + 1) / (tf + norm)

    for seed in range(50):
        terms = sorted(set(pieces[seed].tolist()), key=lambda t: -weight(t, pieces[seed]))
        scores = [
            unused[j] * sum(weight(t, p) for t in terms)
            for j, p in enumerate(pieces)
        ]
        got = index.neighbours(seed, unused, 5)
        best = sorted(scores, reverse=True)[:5]
        assert np.allclose([scores[j] for j in got], [s for s in best if s > 0])


def test_neighbours_score_all_terms():
    """Against BM25 over every distinct term of the seed, common and rare ones."""
    rng = np.random.default_rng(11)
    pieces = [
        (200 * rng.random(rng.integers(30, 90)) ** 3).astype("<u4") for _ in range(60)
    ]
    pieces.append(np.arange(200, 240, dtype="<u4"))
    pieces.append(np.array([239, 5], "<u4"))  # shares one of many equal terms
    idf = rng.random(240).astype(np.float32) + 0.1
    idf[200:239], idf[239] = 2.0, 0.1
    index = packing.ShardIndex(pieces, idf, 50.0)
    assert 0 < len(index.common) < 200
    unused = rng.random(62) < 0.7
    unused[60:] = False, True
    for seed in range(61):
        scores = np.zeros(62)
        for j, piece in enumerate(pieces):
            norm = packing.K1 * (1 - packing.B + packing.B * len(piece) / 50.0)
            for term in set(pieces[seed].tolist()) & set(piece.tolist()):
                tf = int((piece == term).sum())
                scores[j] += float(idf[term]) * tf * (packing.K1 + 1) / (tf + norm)
        scores *= unused
        got = index.neighbours(seed, unused, 7)
        best = np.sort(scores)[::-1][:7]
        assert np.allclose(scores[got], best[best > 0])
    assert index.neighbours(60, unused, 7).tolist() == [61]


def test_long_documents_are_found_by_their_remainders():
    """Also while a window is open, as in every later shard of a task."""
    long = packing.Doc("long", np.array([1] * 16 + [2] * 4, "<u4"))
    head = packing.Doc("head", np.array([1, 3, 1], "<u4"))
    tail = packing.Doc("tail", np.array([2, 4], "<u4"))
    windows = packing.Windows(8, 0)
    windows.add(packing.Doc("before", np.array([5] * 7, "<u4")), 0, 7)
    packing.fill([long, head, tail], np.ones(6, np.float32), 8.0, windows)
    windows.finish()
    got = [(d.doc_id, start, n) for d, start, n, _, _ in windows.done]
    assert got[:2] == [("long", 0, 8), ("long", 8, 8)]
    # What the open window left of the remainder is joined by the piece like it.
    assert got[2:] == [
        ("before", 0, 7), ("long", 16, 1), ("long", 17, 3), ("tail", 0, 2), ("head", 0, 3),
    ]


def test_similar_documents_share_windows(spark, scratch):
    a, b = "apple pear plum cherry grape ", "steel iron copper bronze zinc "
    rows = [(i, (a if i % 2 else b) * 4) for i in range(64)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    out = packing.packed(docs, PATH, registry.END_ID, scratch.keep, 128)
    mixed = out.groupBy("sequence_id").agg(F.countDistinct(F.col("doc_id") % 2).alias("kinds"))
    assert mixed.filter("kinds > 1").count() <= 2


def test_no_rows(spark, scratch, no_docs):
    assert packing.packed(no_docs, PATH, registry.END_ID, scratch.keep).count() == 0


def test_very_many_short_texts_end_in_seconds():
    """Linear enough: documents of one to four ids, and as many empty ones."""
    rng = np.random.default_rng(12)
    docs = [
        packing.Doc(i, np.append(rng.integers(3, 4000, rng.integers(0, 4)), 2).astype("<u4"))
        for i in range(100_000)
    ]
    docs += [packing.Doc(i, np.array([2], "<u4")) for i in range(100_000, 200_000)]
    idf = rng.random(4000).astype(np.float32) + 0.5
    idf[2] = 0
    windows = packing.Windows(4096, 0)
    start = time.process_time()
    packing.fill(docs, idf, 2.5, windows)
    windows.finish()
    assert time.process_time() - start < 60
    taken = {d.doc_id: n for d, _, n, _, _ in windows.done}
    assert len(taken) == 200_000
    assert sum(n for _, _, n, _, _ in windows.done) == sum(len(d.ids) for d in docs)


def test_index_of_unused_pieces_is_built_anew():
    rng = np.random.default_rng(13)
    pieces = [rng.integers(0, 50, 12).astype("<u4") for _ in range(64)]
    idf = rng.random(50).astype(np.float32) + 0.1
    shard = packing.Unused(pieces, idf, 12.0)
    whole = packing.ShardIndex(pieces, idf, 12.0)
    unused = np.ones(64, bool)
    for piece in rng.permutation(64)[:60].tolist():
        shard.take(piece)
        unused[piece] = False
        terms = whole.terms(piece)
        assert shard.search(terms, 12 * 64) == whole.search(terms, unused, 64).tolist()
    assert shard.left == 4 and len(shard.members) < 16


def test_blocks_of_texts(tokenizer, monkeypatch):
    """Words up to and beyond 16 bytes, equal marks, nulls and texts longer than a block."""
    rng = random.Random(14)
    words = ["a", "a\x00", "\x00", "abcdefgh", "abcdefghi", "sixteen-bytes-ab", "sixteen-bytes-abc",
             "Grüße", "übergrößenträger", "übergrößenträgers", "ΣΑΣ", "e\u0301", "漢字", "x" * 60, "1,5"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 30))) for _ in range(60)]
    texts += [None, "", "  ", "\n", " a  b ", " ".join(rng.choices(words, k=3000))]
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    monkeypatch.setattr(packing, "BLOCK", 2000)
    for mix in (packing._MIX, np.uint64(0)):  # without mixing all words have one mark
        monkeypatch.setattr(packing, "_MIX", mix)
        ids, sizes = packing.Encoder(PATH).ids(texts)
        assert sizes.tolist() == [len(w) for w in want]
        assert ids.tolist() == [i for w in want for i in w]


def test_words_met_again_stay_known(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 20)
    encoder = packing.Encoder(PATH)
    for i in range(40):
        text = f"Common words, wor{chr(97 + i % 26) * 2}d{'x' * i} été! the Common 1{i}"
        got = encoder.ids([text])[0].tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids
    assert len(encoder) < 60 and "words," in encoder


def test_frequencies_of_the_tokenising_pass(spark, scratch, folder):
    docs = table(spark, folder, "documents")
    tokens = scratch.keep(packing.tokenise(docs, PATH, registry.END_ID), "tokens")
    found, documents, mean = packing.document_frequencies(tokens)
    rows = [np.frombuffer(r.ids, "<u4") for r in tokens.filter("ids IS NOT NULL").collect()]
    expected = np.zeros(len(found), np.int64)
    for ids in rows:
        expected[np.unique(ids)] += 1
    assert documents == len(rows) == docs.count()
    assert (found == expected).all() and np.isclose(mean, np.mean([len(i) for i in rows]))


def test_many_texts_are_encoded_in_little_memory(tokenizer):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(rng.choices(words, k=700)) for _ in range(800)]
    encoder = packing.Encoder(PATH)
    encoder.ids([" ".join(words)])
    tracemalloc.start()
    try:
        ids, sizes = encoder.ids(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 50e6
    ends = np.cumsum(sizes)
    for i in (0, 399, 799):
        assert ids[ends[i] - sizes[i] : ends[i]].tolist() == ids_of(tokenizer, texts[i])[:-1]


def test_a_closing_mark_makes_no_new_word(tokenizer):
    """A word is looked up once, whether or not a mark closes it; the ids stay the same."""
    encoder = packing.Encoder(PATH)
    words = ["plain", "Grüße", "a", "x-y", "1a", "ab1", "étoile", "a.b", "sixteen-bytes-abc"]
    plain = " ".join(words)
    encoder.ids([plain + " , . ; ) "])
    known = len(encoder)
    marked = " ".join(w + mark for w in words if w[-1].isalpha() for mark in ",.;)")
    texts = [marked, "a,b, c.. d! ,, e?! é, É. \u00e9t\u00e9\u0301, (x) ,a", "x,", ",", "x ,"]
    got = encoder.ids([marked])[0].tolist()
    assert got == tokenizer.encode(marked, add_special_tokens=False).ids
    assert len(encoder) == known and "plain," in encoder and "other," not in encoder
    ids, sizes = encoder.ids(texts)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_equal_words_and_tokens_are_grouped_as_by_stable_sorts():
    rng = np.random.default_rng(3)
    top = np.iinfo(np.uint64).max
    for values in (
        rng.integers(0, 50, 400).astype(np.uint64),
        np.array([top, 0, top, 7], np.uint64),
        np.zeros(3, np.uint64),
        np.zeros(0, np.uint64),
    ):
        first, kind = packing._alike(values)
        assert len(first) == len(set(values.tolist()))
        assert (values[first][kind] == values).all()
    for terms in (1 << 16, 1 << 17):
        token = rng.integers(0, terms, 5000)
        token[:100] = terms - 1
        assert (packing._by_token(token, terms) == np.argsort(token, kind="stable")).all()
