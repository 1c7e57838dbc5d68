from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from llm_fixtures import edge_docs, folder, no_docs  # noqa: F401
from ledgerloom.llm import langid, registry
from ledgerloom.llm.common import table


def brute(text: str, model: langid.Model) -> np.ndarray:
    table_ = langid.letters_table()
    total = model.log_prior.copy()
    for rows in langid.bucket_rows([(text, len(text))], table_):
        for b in rows:
            total = total + model.log_prob[b]
    return total


def test_held_out_accuracy(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "lang")
    out = registry.op2_language_id(spark, folder)
    judged = out.join(docs, "doc_id").filter("held_out AND lang IS NOT NULL")
    right = judged.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97
    assert out.filter("score < 0 OR score > 1").isEmpty()


def test_blocks_and_slices_match_one_by_one(monkeypatch, rng=np.random.default_rng(1)):
    words = ["der", "Hund", "the", "dog", "été", "ñu", "漢字", "12", "!"]
    texts = [" ".join(rng.choice(words, n)) for n in (0, 1, 2, 7, 60, 300)] + [None, "9 9"]
    matrix = np.vstack([np.log(rng.random((langid.BUCKETS, 3))), np.zeros(3)])
    model = langid.Model(["a", "b", "c"], matrix, np.log([0.2, 0.3, 0.5]))
    whole = langid.score_texts(texts, model, langid.letters_table())
    monkeypatch.setattr(langid, "SLICE", 1 << 14)
    for text, (lang, score) in zip(texts, whole):
        if not text or not any(c.isalpha() for c in text):
            assert (lang, score) == ("und", 0.0)
            continue
        total = brute(text, model)
        assert lang == model.languages[int(total.argmax())]
        assert np.isclose(score, np.exp(total.max() - np.logaddexp.reduce(total)))


def test_long_text_is_scored_whole():
    model = langid.Model(
        ["a", "b"],
        np.vstack([np.random.default_rng(2).normal(-9, 1, (langid.BUCKETS, 2)), np.zeros(2)]),
        np.log([0.5, 0.5]),
    )
    text = "ab cde fgh " * 9000  # several slices of the smallest size
    parts = list(langid.slices(text, 1 << 14))
    assert len(parts) > 5
    sliced = sum(
        model.log_prob[rows].sum(0)
        for p in parts
        for rows in langid.bucket_rows([p], langid.letters_table())
    )
    assert np.allclose(sliced + model.log_prior, brute(text, model))


def test_edges(edge_docs, no_docs):
    model = langid.fit(edge_docs)
    out = langid.predict(edge_docs, model, edge_docs.columns)
    found = {(r.row.doc_id, r.row.text): r.lang_pred for r in out.collect()}
    assert out.count() == edge_docs.count()
    assert found[3, None] == found[4, ""] == found[7, "1234 !!! ---"] == "und"
    assert found[1, "The quick brown fox jumps over the lazy dog"] == "en"
    nothing = langid.fit(no_docs)
    assert {r.lang_pred for r in langid.predict(edge_docs, nothing, ["doc_id"]).collect()} == {
        "und"
    }
    assert langid.predict(no_docs, model, ["doc_id"]).count() == 0


def test_signs_of_numbers_are_no_letters():
    model = langid.Model(["a", "b"], np.zeros((langid.BUCKETS + 1, 2)), np.log([0.5, 0.5]))
    signs = ["½", "²", "Ⅷ", "①", "½ ² Ⅷ ① 12 _", "٣", "²" * 5000]
    letters = ["ª", "ß", "漢", "½x", "① é"]
    for text in signs + letters:
        assert langid.has_letter(text) == any(c.isalpha() for c in text)
    found = langid.score_texts(signs + letters, model, langid.letters_table())
    assert [f[0] for f in found] == ["und"] * len(signs) + ["a"] * len(letters)
