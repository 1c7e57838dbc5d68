from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from llm_fixtures import edge_docs, folder, no_docs  # noqa: F401
from ledgerloom.llm import registry, sharding
from ledgerloom.llm.common import table


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (4, 2)])
def test_neighbours_on_the_curve_touch(spark, dims, bits):
    cells = [
        F.shiftright("id", bits * j).bitwiseAND(F.lit((1 << bits) - 1)).alias(f"c{j}")
        for j in range(dims)
    ]
    df = spark.range(1 << (dims * bits)).select(*cells)
    out = df.select(sharding.hilbert_index([F.col(c) for c in df.columns], bits).alias("h"), "*")
    found = sorted(map(tuple, out.collect()))
    assert [r[0] for r in found] == list(range(1 << (dims * bits)))
    for a, b in zip(found, found[1:]):
        assert sum(abs(x - y) for x, y in zip(a[1:], b[1:])) == 1


def law_holds(rows, shards):
    slots: dict[int, list[int]] = {}
    for shard, slot in rows:
        slots.setdefault(shard, []).append(slot)
    counts = [len(slots.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_rows_law_on_given_documents(spark, folder):
    out = registry.op8_hilbert_sharding(spark, folder).collect()
    law_holds([(r.shard, r.slot) for r in out], registry.SHARDS)
    want = table(spark, folder, "documents").select(
        "doc_id", F.octet_length("text") + 16, F.crc32("text")
    )
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in out) == sorted(
        map(tuple, want.collect())
    )


def test_shards_are_compact(spark, folder):
    """A shard spans fewer values of each dimension than all rows do."""
    docs = table(spark, folder, "documents").withColumn("by", F.concat(F.lit("https://a."), "source"))
    from ledgerloom.scratch import Scratch

    out = sharding.hilbert_shards(
        docs, {"by": F.col("by"), "n_chars": F.col("n_chars")}, Scratch(spark), 8
    )
    spread = out.groupBy("shard").agg(F.countDistinct("source").alias("n")).agg(F.avg("n"))
    assert spread.first()[0] < 0.8 * docs.select("source").distinct().count()


def test_edges(spark, scratch, edge_docs, no_docs):
    dims = {"doc_id": F.col("doc_id"), "size": F.length("text")}
    out = sharding.hilbert_shards(edge_docs, dims, scratch, 5)
    assert sorted(out.columns) == sorted({*edge_docs.columns, "shard", "slot"})
    law_holds([(r.shard, r.slot) for r in out.collect()], 5)
    keep = ["doc_id", "text", "rank", "row"]
    assert Counter(out.select(keep).collect()) == Counter(edge_docs.select(keep).collect())
    assert sharding.hilbert_shards(no_docs, dims, scratch, 5).count() == 0
    same = edge_docs.limit(1).crossJoin(spark.range(23).select(F.lit(1).alias("one")))
    law_holds(
        [(r.shard, r.slot) for r in sharding.hilbert_shards(same, dims, scratch, 4).collect()], 4
    )


def test_written_shards(spark, scratch, edge_docs, tmp_path):
    out = sharding.hilbert_shards(edge_docs, {"doc_id": F.col("doc_id")}, scratch, 3)
    sharding.write_shards(out, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == edge_docs.count() and back.select("shard").distinct().count() == 3


def test_cuts_of_whole_strings(spark, scratch):
    """Strings that begin alike are told apart; a hot one takes a run of its own."""
    texts = [f"https://common.beginning.example/{i:04}" for i in range(640)]
    texts += ["https://common.beginning.example/0300"] * 640 + [None] * 50 + [""]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(4)
    cuts = sharding.text_cuts(df, F.col("t"), 8, scratch.keep)
    assert cuts == sorted(cuts) and 4 <= len(cuts) <= 7
    known = [t for t in texts if t is not None]
    sizes = [0] * (len(cuts) + 1)
    for t in known:
        sizes[sum(c < t for c in cuts)] += 1
    light = sorted(sizes)[:-1]
    assert max(light) <= len(known) / 8 + 1 and max(sizes) <= 640 + len(known) / 8
    assert sharding.text_cuts(df.limit(0), F.col("t"), 8, scratch.keep) == []
    assert sharding.text_cuts(df.filter("t = ''"), F.col("t"), 8, scratch.keep) == []


def test_whole_rows_against_brute_force(spark, scratch, folder):
    """Shard and slot of each row, from cells and an order computed here."""
    rows = [
        (r.doc_id, r.lang, "https://www." + r.source, len(r.text or ""))
        for r in table(spark, folder, "documents").collect()
    ]
    rows += rows[:5] + [(None, None, None, None), (7, "", "", 0)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, source string, size int")
    bits, shards, dims = 3, 7, ["lang", "source", "size"]
    columns = {c: F.col(c) for c in dims}

    def text_cell(values, v):
        counts, upto, cuts = Counter(x for x in values if x is not None), 0, []
        whole = sum(counts.values())
        for x in sorted(counts, key=str.encode):
            before, upto = upto, upto + counts[x]
            if upto < whole and upto * 8 // whole > before * 8 // whole:
                cuts.append(x)
        return 0 if v is None else sum(c < v for c in cuts)

    cuts = df.agg(F.percentile_approx("size", [i / 8 for i in range(1, 8)], 2000)).first()[0]
    cell = [
        (text_cell([x[1] for x in rows], r[1]), text_cell([x[2] for x in rows], r[2]),
         0 if r[3] is None else sum(c <= r[3] for c in cuts))
        for r in rows
    ]
    distinct = spark.createDataFrame(sorted(set(cell)), "a long, b long, c long")
    index = sharding.hilbert_index([F.col(c) for c in "abc"], bits).alias("h")
    curve = {(r.a, r.b, r.c): r.h for r in distinct.select("a", "b", "c", index).collect()}

    def order(i):
        return (curve[cell[i]], *[(v is None, v.encode() if isinstance(v, str) else v) for v in rows[i]])

    n = len(rows)
    want = []
    for rank, i in enumerate(sorted(range(n), key=order)):
        shard = rank * shards // n
        want.append((*rows[i], shard, rank - -(-shard * n // shards)))
    out = sharding.hilbert_shards(df, columns, scratch, shards, bits)
    assert Counter(map(tuple, out.collect())) == Counter(want)
