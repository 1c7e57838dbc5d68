from __future__ import annotations

import random
import re
from collections import Counter
from functools import partial

import pytest
from pyspark.sql import functions as F

from llm_fixtures import edge_docs, no_docs  # noqa: F401
from ledgerloom.llm import collocations, stripes
from ledgerloom.llm.common import text_slices

WORDS = "the of New york York über x\x00y a-b 12  z and".split(" ")


def brute(rows, least, longest=5, cover=100, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    cands = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}

    def inside(small, large):
        return any(large[i : i + len(small)] == small for i in range(len(large) - len(small) + 1))

    out = []
    for (lang, p), a in cands.items():
        if any(
            g[0] == lang and len(g[1]) > len(p) and 100 * b >= cover * a and inside(p, g[1])
            for g, b in cands.items()
        ):
            continue
        cuts = []
        for k in range(1, len(p)):
            left, right = f[lang, p[:k]], f[lang, p[k:]]
            cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
        value, _, left, right = min(cuts)
        out.append((lang, " ".join(p), a, left, right, n[lang], value))
    ranked = []
    for lang in {o[0] for o in out}:
        mine = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[6], -o[2], o[1].encode()))
        ranked += [(lang, i + 1, *o[1:]) for i, o in enumerate(mine[:top])]
    return sorted(ranked)


def made(seed, texts=60):
    rng = random.Random(seed)
    phrases = [rng.choices(WORDS, k=rng.randint(2, 6)) for _ in range(6)]
    out = []
    for _ in range(texts):
        parts = []
        for _ in range(rng.randint(0, 40)):
            parts += rng.choice(phrases) if rng.random() < 0.5 else [rng.choice(WORDS)]
            if rng.random() < 0.1:
                parts.append(rng.choice([".", ",", "\n", "\x0b", "!?", " \t "]))
        out.append((rng.choice(["en", "de", None, "und"]), " ".join(parts)))
    return out


def found(spark, scratch, rows, **options):
    df = spark.createDataFrame(
        [(i, t, lang, 1, 2, "p") for i, (lang, t) in enumerate(rows)],
        "doc_id long, text string, lang string, n long, rank int, phrase string",
    ).repartition(3)
    return sorted(map(tuple, collocations.collocations(df, scratch.keep, **options).collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, scratch, seed):
    rows = made(seed) + [(None, None), ("en", ""), ("fr", "..,"), ("en", "new york " * 30)]
    assert found(spark, scratch, rows, least=5) == brute(rows, 5)


def test_covered_and_top(spark, scratch):
    rows = made(3)
    expected = brute(rows, 4, longest=4, cover=70, top=9)
    assert found(spark, scratch, rows, least=4, longest=4, cover=70, top=9) == expected


def test_small_blocks_and_cut_stripes(spark, scratch, monkeypatch):
    """Texts that span blocks, and stripes cut into segments, count the same."""
    rows = made(4, 20) + [("en", " ".join(random.Random(5).choices(WORDS, k=4000)))]
    expected = brute(rows, 5)
    monkeypatch.setattr(stripes, "HOT", 1_000_000)  # every frequent prefix is cut
    monkeypatch.setattr(collocations, "text_slices", partial(text_slices, size=50))
    assert found(spark, scratch, rows, least=5, block=64) == expected


def test_full_filter_changes_nothing(spark, scratch, monkeypatch):
    """A filter that lets everything through costs time only."""
    rows = made(6, 25)
    real = stripes.filter_of
    monkeypatch.setattr(stripes, "filter_of", lambda keys: real(keys) | ~real(keys))
    assert found(spark, scratch, rows, least=5) == brute(rows, 5)


def test_edges(spark, scratch, edge_docs, no_docs):
    assert collocations.collocations(no_docs, scratch.keep).count() == 0
    got = collocations.collocations(edge_docs, scratch.keep, least=100)
    rows = [(r.lang, r.text) for r in edge_docs.collect()]
    assert sorted(map(tuple, got.collect())) == brute(rows, 100)
    assert got.count() > 0


def test_scores_are_exact_beyond_64_bits(spark):
    cases = [
        (10**12, 10**13, 10**12, 10**12 + 7),
        (123_456_789_012, 98_765_432_109_876, 222_222_222_223, 333_333_333_337),
        (100, 10**13, 100, 100),
        (100, 100, 10**11, 10**11),
    ]
    df = spark.createDataFrame(cases, "a long, n long, l long, r long")
    got = df.select(collocations.score(*[F.col(c) for c in "anlr"])).collect()
    assert [g[0] for g in got] == [1000 * a * n // (x * y) for a, n, x, y in cases]
