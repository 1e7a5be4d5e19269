"""Segmented concatenation: chunks joined equal the documents, also for a hot item."""

import random

import pytest

from rankloom.operators import docs as D

SCHEMA = "asin string, unixReviewTime long, reviewerID string, overall double, reviewText string, summary string"


@pytest.mark.parametrize("parts,chunk", [(1, 20), (8, 11), (40, 1 << 16)])
def test_chunks_joined_are_the_documents(spark, parts, chunk):
    r = random.Random(parts)
    rows = []
    for i in range(600):
        item = "hot" if r.random() < .4 else f"I{r.randrange(60):03d}"
        text = r.choice([None, "", "x", "é ß", "a longer text with words ", "z" * r.randrange(70)])
        rows.append((item, r.choice([None, 1, 2, 3]), f"u{r.randrange(9)}", 5.0, text, r.choice([None, "sum"])))
    rows += rows[:20]
    clean = spark.createDataFrame(rows, SCHEMA).repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        chunks = D.item_document_chunks(clean, chunk_chars=chunk).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    got: dict = {}
    for c in sorted(chunks, key=lambda c: (c["asin"], c["at"])):
        assert c["at"] == len(got.get(c["asin"], "")) and 0 < len(c["text"]) <= chunk + 1
        got[c["asin"]] = got.get(c["asin"], "") + c["text"]
    want = {x["asin"]: x["combinedText"] for x in D.item_documents(clean).collect()}
    assert got == want and len(want["hot"]) > 1000
    if parts > 1:      # the hot item was spread
        assert len([c for c in chunks if c["asin"] == "hot"]) > 1


def test_no_documents(spark):
    assert D.item_document_chunks(spark.createDataFrame([], SCHEMA)).count() == 0
    short = spark.createDataFrame([("a", 1, "u", 5.0, "short", None)], SCHEMA)
    assert D.item_document_chunks(short).count() == 0
    with pytest.raises(ValueError):
        D.item_document_chunks(short, chunk_chars=5)


def test_texts_are_shuffled_once(spark):
    clean = spark.createDataFrame([("a", 1, "u", 5.0, "some longer text", None)], SCHEMA)
    p = D.item_document_chunks(clean)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in p


def test_documents_take_one_shuffle_and_no_aggregate(spark):
    """Texts are in no aggregate's buffer; order, blanks, nulls and short items as documented."""
    clean = spark.createDataFrame(
        [("a", 2, "u", 4.0, "second", None), ("a", 1, "v", None, "first ", None), ("a", None, "w", 2.0, "", None),
         ("b", 1, "u", 5.0, "short", None), (None, 1, "u", None, "no item at all", None),
         ("c", 1, "u", 5.0, None, None), ("c", 1, "u", 1.0, None, "a summary alone")], SCHEMA)
    docs = D.item_documents(clean)
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and plan.count("RepartitionByExpression") == 1
    assert sorted(map(tuple, docs.collect()), key=str) == [
        ("a", " first  second", 3, 3.0), ("c", "a summary alone", 1, 1.0),
        (None, "no item at all", 1, None)]


def test_chunks_joined_tell_a_gap(spark):
    rows = [("a", 0, "xy"), ("a", 2, "z"), ("b", 5, "q"), ("b", 0, "1234"), ("c", 0, "one")]
    got = D.joined_chunks(spark.createDataFrame(rows, "asin string, at long, text string")).collect()
    assert sorted(map(tuple, got)) == [("a", "xyz", True, 2), ("b", "1234q", False, 4), ("c", "one", True, 3)]


def test_words_in_arrow_are_those_of_the_jvm(spark, monkeypatch):
    """Tokens, counts and trailing empties as native split and StopWordsRemover give them; a text
    longer than a share is cut alone."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(D, "_CUT_BYTES", 40)
    r = random.Random(5)
    words = ["the", "The", "it's", "battery", "é", "ÉTÉ", "themselves", "x" * 30, "İI", " ", " ", "", "t"]
    texts = ["", " ", "  ", "the", "the ", " the", "\t\n\x0b\f\r", "a b", None, "end\r\n", "x" * 500]
    texts += ["".join(r.choice(words) + r.choice(" \t\n\r\x0b\f") * r.choice([0, 1, 1, 2])
                      for _ in range(r.randrange(40))) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3)
    got = {x["id"]: x for x in rows.select(
        "id", D.kept_words(F.lower("text")).alias("w"), D.word_counts(F.lower("text")).alias("n"),
        D.joined_words(F.lower("text")).alias("j")).collect()}
    raw = D.split_tokens("text", keep_trailing=True).alias("raw")
    known = rows.filter("text is not null").select("id", raw)
    for x in D.stop_words_remover("raw", "w").transform(known).collect():
        ends = len(x["raw"]) - max([i + 1 for i, w in enumerate(x["raw"]) if w], default=0)
        assert got[x["id"]]["w"] == x["w"] and got[x["id"]]["j"] == " ".join(x["w"])
        assert tuple(got[x["id"]]["n"]) == (len(x["w"]), ends)
    assert got[8]["w"] is None and got[8]["j"] is None and tuple(got[8]["n"]) == (None, None)


def test_counting_makes_no_tokens(spark):
    """Item figures and the rows of embeddable parts read counts: tokens are not made for them."""
    from rankloom.operators import embed as EM
    parts = spark.createDataFrame([("a", 1, "u", 5.0, "some text")], "asin string, unixReviewTime long, "
                                  "reviewerID string, overall double, text string")
    toks = EM.part_tokens(parts)
    stats = EM.item_token_stats(toks)
    for df in (stats, EM.embeddable_parts(toks, EM.embeddable_items(stats)).select("asin", "nTokens")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "counts(" in plan and "words(" not in plan and "split(" not in plan


def test_texts_are_shuffled_compressed(spark):
    """Documents, their tokens, and chunks of items that are not hot: no exchange has a text, only packed rows."""
    clean = spark.createDataFrame([(f"i{i}", 1, "u", 5.0, "some longer text", None) for i in range(90)], SCHEMA)
    chunks = D.item_document_chunks(clean, chunk_chars=11)
    for df in (D.item_documents(clean), D.item_tokens(D.item_documents(clean)), chunks, D.joined_chunks(chunks)):
        plan = df._jdf.queryExecution().optimizedPlan()
        found = [line for line in plan.toString().splitlines() if "RepartitionByExpression" in line]
        assert found and all("group#" in line for line in found)
        node, outputs = [plan], []
        while node:
            x = node.pop()
            if x.nodeName() == "RepartitionByExpression":
                outputs.append(x.output().mkString(","))
            node += [x.children().apply(i) for i in range(x.children().size())]
        assert outputs and all("rows#" in o and "text#" not in o for o in outputs)


def test_packed_rows_come_back(monkeypatch):
    """Every row of every group once, whatever the packs' sizes; equal rows stay two."""
    import pyarrow as pa
    r = random.Random(3)
    rows = [(r.randrange(7), r.choice([None, "a", "b"]), r.choice([None, "", "é" * r.randrange(90)])) for _ in range(500)]
    rows += rows[:9]
    schema = pa.schema([("_group", pa.int32()), ("asin", pa.string()), ("text", pa.string())])
    batches = [pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[i:i + 40]), schema)], schema=schema)
               for i in range(0, len(rows), 40)]
    for size in (1, 3000, 1 << 20):
        monkeypatch.setattr(D, "_PACK_BYTES", size)
        packed = [x for b in D._pack(iter([*batches, batches[0].slice(0, 0)])) for x in b.to_pylist()]
        packed.sort(key=lambda x: x["group"])
        tables = list(D._grouped(iter(pa.RecordBatch.from_pylist(packed[i:i + 3], D._PACKED)
                                      for i in range(0, len(packed), 3))))
        assert len(tables) == 7
        got = [(g, x["asin"], x["text"]) for g, t in enumerate(tables) for x in t.to_pylist()]
        assert sorted(got, key=str) == sorted(rows, key=str)
    assert list(D._pack(iter([]))) == list(D._grouped(iter([]))) == []


def test_documents_of_odd_rows(spark):
    """Order with nulls, ties told by the text's md5, and equal rows, as a plain sort gives them."""
    from hashlib import md5
    r = random.Random(11)
    rows = [(r.choice(["a", "b", "c", None]), r.choice([None, 1, 2]), r.choice([None, "u", "v"]), r.choice([None, 1.0, 4.5]),
             r.choice([None, "", "x y", "é", "long text " * 3]), r.choice([None, "sum"])) for _ in range(300)]
    rows += rows[:40]
    clean = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = []
    for asin in ["a", "b", "c", None]:
        mine = [(t, u, x if x is not None else s, o) for a, t, u, o, x, s in rows if a == asin and (x, s) != (None, None)]
        mine.sort(key=lambda m: ((m[0] is not None, m[0] or 0), (m[1] is not None, m[1] or ""), md5(m[2].encode()).hexdigest()))
        rated = [m[3] for m in mine if m[3] is not None]
        want.append((asin, " ".join(m[2] for m in mine), len(mine), sum(rated) / len(rated)))
    got = [(x[0], x[1], x[2], pytest.approx(x[3])) for x in D.item_documents(clean).collect()]
    assert sorted(got, key=lambda x: str(x[0])) == sorted(want, key=lambda x: str(x[0]))
