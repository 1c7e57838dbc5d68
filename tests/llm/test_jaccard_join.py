from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest

from llm_fixtures import folder, rows  # noqa: F401
from ledgerloom.llm import jaccard_join as jj
from ledgerloom.llm import registry
from ledgerloom.llm.common import table
from ledgerloom.llm.components import components
from ledgerloom.llm.shingles import shingle_sets


def shingles(text, size):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(w) >= size:
        return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    return frozenset([tuple(w)] if w else [])


def brute(docs, size, percent):
    sets = [shingles(t, size) for _, t in docs]
    root, links = list(range(len(docs))), [0] * len(docs)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders: dict[tuple, list[int]] = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {p for h in holders.values() for p in combinations(h, 2)}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
            links[a] += 1
            links[b] += 1
    least: dict[int, int | None] = {}
    for i, (doc_id, _) in enumerate(docs):
        known = [x for x in (least.get(find(i)), doc_id) if x is not None]
        least[find(i)] = min(known, default=None)
    key = lambda r: [(v is None, v) for v in r]
    return sorted(
        (
            (d, len(s), least[find(i)], links[i])
            for i, ((d, _), s) in enumerate(zip(docs, sets))
        ),
        key=key,
    )


def corpus(seed):
    """Unrelated texts, a chain of near copies, a hub of them, shared passages, odd texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghé", k=rng.randint(2, 6)))
    text = lambda n: [word() for _ in range(n)]
    passage = text(30)
    docs = [text(rng.randint(1, 60)) for _ in range(60)]
    docs += [text(40) + passage for _ in range(40)]
    chain = text(80)
    for _ in range(25):
        chain = list(chain)
        chain[rng.randrange(80)] = word()
        docs.append(chain)
    hub = text(70)
    for _ in range(60):
        near = list(hub)
        for _ in range(rng.randint(0, 3)):
            near[rng.randrange(70)] = word()
        docs.append(near)
    docs += [list(rng.choice(docs)) for _ in range(40)]
    docs += [["one", "two"], ["One", "TWO"], ["one"], []]
    out = [(i, " ".join(d)) for i, d in enumerate(docs)]
    out += [(7, out[7][1]), (None, "a b c d e"), (None, "a b c d e"), (9000, None), (9001, "  \n")]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("common,block", [(1 / 500, 1024), (1 / 8, 16)])
def test_brute_force(spark, scratch, monkeypatch, common, block):
    """Also with common shingles and with clusters of several blocks."""
    monkeypatch.setattr(jj, "COMMON", common)
    monkeypatch.setattr(jj, "CLUSTER_BLOCK", block)
    monkeypatch.setattr(jj, "SMALL_TASK", block)
    monkeypatch.setattr(jj, "COMPARED", max(block // 4, 4))
    monkeypatch.setattr(jj, "BLOCK_DOCS", 50)
    docs = corpus(8)
    df = spark.createDataFrame(
        [(*d, "x", 1) for d in docs], "doc_id long, text string, cls string, n int"
    ).repartition(5)
    out = jj.jaccard_join(df, scratch, size=4, percent=85)
    assert rows(out) == brute(docs, 4, 85)


def test_given_documents(spark, folder):
    docs = list(map(tuple, table(spark, folder, "documents").select("doc_id", "text").collect()))
    assert rows(registry.op9_ngram_join(spark, folder)) == brute(docs, 4, 85)


def test_no_rows(spark, scratch):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert jj.jaccard_join(none, scratch, 4, 85).count() == 0


def test_law_is_exact():
    law = jj.Law(85)
    for n in range(1, 60):
        for m in range(1, 60):
            least = int(law.overlap(np.array(n), np.array(m)))
            linked = [o for o in range(min(n, m) + 1) if 100 * o >= 85 * (n + m - o)]
            assert not linked or min(linked) == least
            # Overlap outside the prefix cannot reach the least overlap with any size.
            assert n - int(law.prefix(np.array(n))) < -(-85 * n // 100)


def test_shingle_sets():
    texts = ["a b c d", "A  B\tc\nd", "a b", "", None, "ab c d e", "é\u00a0x y z w"] + ["q " * 9]
    sets = list(shingle_sets(texts, 4))
    assert [len(s) for s in sets] == [len(shingles(t, 4)) for t in texts]
    assert (sets[0] == sets[1]).all() and sets[0][0] != sets[5][0]


def test_components(spark, scratch):
    edges = [(i, i + 1) for i in range(70)] + [(100, 101), (102, 101), (103, 103)]
    df = spark.createDataFrame(edges, "a long, b long")
    want = [(i, 0) for i in range(71)] + [(i, 100) for i in (100, 101, 102)] + [(103, 103)]
    assert rows(components(df, scratch.keep)) == want
