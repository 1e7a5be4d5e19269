"""The pipeline's stages one after another, and the rule that nothing else imports llm."""

import re
from pathlib import Path

import corpus_pipeline as C
from rankloom.llm.queries import QUERIES
from tests.conftest import ROOT, SMALL


def test_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert len(C.STAGES) == 5
    whole = docs.count()
    for i, (name, stage) in enumerate(C.STAGES):
        from rankloom.llm.common import stash
        after = stash(stage(spark, docs, SMALL), f"test-{name}")
        if i < 4:
            assert after.columns == docs.columns and after.schema == docs.schema
            assert after.count() <= docs.count()
            if "n_chars" in after.columns and i:
                assert after.filter("n_chars != length(text)").count() == 0
        docs = after
    assert .5 * whole < docs.count() <= whole
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert docs.filter("n_tokens != size(ids)").count() == 0


def test_planted_cases(spark, tmp_path):
    from tests.llm.conftest import prose
    bench = prose(900, 30)
    clean = [(i, "\n".join(prose(1000 + 10 * i + j, 30) for j in range(3))) for i in range(40)]
    base = clean[0][1].split("\n")
    near = [(100, "\n".join(base)), (101, "\n".join(x + " more" for x in base))]
    leak = (200, prose(901, 30) + "\n" + prose(902, 20) + " " + bench + " " + prose(903, 20))
    rows = [(k, t, "en", "s", len(t)) for k, t in [*clean, *near, leak, (300, "12 34 !!")]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    d = str(tmp_path)
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    docs.write.parquet(f"{d}/documents.parquet")
    f = dict(C.STAGES)
    assert 300 not in {r["doc_id"] for r in f["language_id"](spark, docs, d).collect()}
    lined = {r["doc_id"]: r["text"] for r in f["line_dedup"](spark, docs, d).collect()}
    assert 100 not in lined and 101 not in lined
    assert all(lined[k] == t for k, t in clean) and lined[200] == leak[1]
    single = {r["doc_id"] for r in f["jaccard_join"](spark, docs, d).collect()}
    assert single == {k for k, _ in clean} | {200, 300}
    cleaned = {r["doc_id"]: r["text"] for r in f["decontamination"](spark, docs, d).collect()}
    assert bench not in cleaned[200] and len(cleaned) == len(rows)
    assert all(cleaned[k] == t for k, t in clean)
    assert C.run(spark, d).count() == 41


def test_empty_and_awkward_documents(spark, awkward, empty):
    for _, stage in C.STAGES:
        assert stage(spark, empty, SMALL).count() == 0
        stage(spark, awkward, SMALL).count()


def test_one_row_of_equal_rows_and_of_rows_without_a_key(spark):
    from tests.llm.conftest import prose
    a, b, c, d = (prose(1200 + i, 60) for i in range(4))
    rows = [(1, a), (1, a), (1, a), (2, a + " more"), (3, b), (3, c), (None, d), (None, d), (None, c),
            (None, a), (None, None), (None, None)]
    docs = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(rows)],
                                 "doc_id long, text string, row int").repartition(4)
    out = dict(C.STAGES)["jaccard_join"](spark, docs, SMALL)
    assert out.schema == docs.schema
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    want = [(1, a), (3, b), (3, c), (None, d), (None, None), (None, None)]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_nothing_else_imports_the_subpackage():
    for p in Path(ROOT).joinpath("rankloom").rglob("*.py"):
        if "llm" not in p.parts:
            assert not re.search(r"rankloom\.llm|corpus_pipeline", p.read_text()), p
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))
