"""Op 9: held-out accuracy, backing off, and the cases without a language."""

import zlib

from pyspark.sql import functions as F

from rankloom.llm import language as L
from rankloom.llm.queries import op9_language
from tests.conftest import SMALL


def test_held_out_accuracy(spark):
    got = op9_language(spark, SMALL)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {k for k in truth if zlib.crc32(str(k).encode()) % 3 == 1}
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in held) >= .95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_known_words_first_then_shorter_grams(spark):
    docs = spark.createDataFrame(
        [(i, "the house and the river are here", "en") for i in range(4)]
        + [(9 + i, "das Haus und der Fluss sind hier", "de") for i in range(4)],
        "doc_id long, text string, lang string")
    model = L.learn(docs)
    assert model.langs == ["de", "en"]
    s = L.Scorer(model)
    assert s.word("haus") == model.tables[0]["haus"]
    assert s.word("hausen")[0] > s.word("hausen")[1]        # by its 4-grams
    assert s.word("zzund")[0] > 0 and s.word("jjj") == (0.0, 0.0)
    assert s.predict(["Haus", "HOUSE", "", None, "12 ²", "jjj"])[0] == [
        "de", "en", "und", "und", "und", "de"]


def test_model_size_is_bounded_by_frequency(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_WORDS", 5)
    docs = spark.createDataFrame([(i, " ".join(f"w{chr(97 + j)}" for j in range(26) for _ in range(j))
                                   , "en") for i in range(3)], "doc_id long, text string, lang string")
    words = L.learn(docs).tables[0]
    assert 0 < len(words) <= 5 and "wz" in words


def test_awkward_rows(awkward, empty):
    model = L.learn(awkward.filter(L.fold() != 1))
    out = L.predict(awkward, model)
    assert out.columns == [c for c in awkward.columns if c != "score"] + ["lang_pred", "score"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == awkward.count()
    for k in (0, 1, 2, 5):
        assert rows[k]["lang_pred"] == "und" and rows[k]["score"] == 0
    assert rows[None]["lang_pred"] in model.langs
    assert L.predict(empty, model).count() == 0
    none = L.learn(empty)
    assert L.predict(awkward, none).filter(F.col("lang_pred") != "und").count() == 0


def test_a_large_language_displaces_no_words_of_a_small_one(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_WORDS", 30)
    big = " ".join("b" + chr(97 + i) + chr(97 + j) for i in range(20) for j in range(20))
    small = " ".join("s" + chr(97 + i) for i in range(20))
    docs = spark.createDataFrame([(i, big, "big") for i in range(50)] + [(99, small, "small")],
                                 "doc_id long, text string, lang string")
    model = L.learn(docs)
    words = model.tables[0]
    assert set(small.split()) <= set(words)
    assert 0 < len(set(big.split()) & set(words)) <= 30      # one count class, larger than fits
    assert " baa " in model.tables[5]
