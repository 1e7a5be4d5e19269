"""Op 8: figures against brute force, the exact tail, and what the risk control promises."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rankloom.llm.quality import cutoffs, figures, judge, log_binomial_tail
from tests.llm.conftest import prose


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = set()
    for i in range(len(w) - 4):
        if seen[tuple(w[i:i + 5])] > 1:
            covered |= set(range(i, i + 5))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered),
            len(w) < 10 or 100 * len(covered) > 20 * len(w))


def test_figures(spark, awkward):
    r = random.Random(41)
    docs = [(i, "".join(r.choice(["a", "b", "c", "#", "é"]) + r.choice([" ", "\n", "", "\x0b"])
                        for _ in range(r.randint(0, 90)))) for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id long, text string").unionByName(
        awkward.select("doc_id", "text"))
    src = sorted((str(x["doc_id"]), base(x["text"])) for x in df.collect())
    got = sorted((str(x["doc_id"]), tuple(x[2:7]) + (x["base_failed"],))
                 for x in figures(df, stratum=None).collect())
    assert got == src


def test_binomial_tail(spark):
    cases = [(n, r, p) for n in (1, 10, 500, 4000) for r in (0, 1, 3, 17) for p in (.005, .1)
             if r < n * p]
    for p in (.005, .1):
        df = spark.createDataFrame([(n, r) for n, r, q in cases if q == p], "n long, r long")
        for x in df.select("*", log_binomial_tail(F.col("n"), F.col("r"), p).alias("t")).collect():
            want = math.fsum(math.comb(x["n"], k) * p ** k * (1 - p) ** (x["n"] - k)
                             for k in range(x["r"] + 1))
            assert x["t"] == pytest.approx(math.log(want), abs=1e-9)
    one = spark.createDataFrame([(10, 5)], "n long, r long")
    assert one.select(log_binomial_tail(F.col("n"), F.col("r"), .1)).first()[0] == 0.0


def test_strictest_valid_cutoff_per_stratum(spark):
    rows = [("en", i / 5000) for i in range(5000)] + [("de", 0.5)] * 40
    df = spark.createDataFrame(rows, "stratum string, score double")
    grid = {"score": (.5, .9, .99, .9999)}
    got = {r["stratum"]: r["score_cut"] for r in cutoffs(df, .05, .05, grid).collect()}
    # of 5000 good rows .99 rejects 1 %, .9 rejects 10 %; 40 rows prove nothing
    assert got == {"en": .99, "de": None}


def test_false_rejections_are_limited(spark):
    r = random.Random(43)
    good = [(i, prose(i, 30), "en") for i in range(1500)]
    bad = [(5000 + i, " ".join(r.choice(["##", "$$%", "word", "and"]) for _ in range(30)), "en")
           for i in range(300)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(k, int(k < 5000), 0) for k, _, _ in good + bad],
                                   "doc_id long, quality int, toxic int")
    kept = {x["doc_id"] for x in judge(docs, labels, alpha=.01).filter("kept").collect()}
    assert sum(k >= 5000 for k in kept) < 30
    assert sum(k < 5000 for k in kept) > 1500 * .95


def test_only_native_operations_and_awkward_rows(spark, awkward, empty):
    labels = spark.createDataFrame([(6, 1, 0), (6, 1, None), (None, None, None), (8, 0, 1)],
                                   "doc_id long, quality int, toxic int")
    out = judge(awkward, labels)
    plan = figures(awkward)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(
        str(r["doc_id"]) for r in awkward.collect())
    assert not out.filter("kept and base_failed").count()
    assert judge(empty, labels).count() == 0
    assert judge(awkward, labels.limit(0)).filter("kept = base_failed").count() == 0
