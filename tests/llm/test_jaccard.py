"""Op 2 against brute force over all pairs, and the components it uses."""

import random

from rankloom.llm.graph import components
from rankloom.llm.jaccard import jaccard_components
from tests.llm.conftest import key_of, prose, words_of


def shingle_set(text, n):
    w = words_of(text)
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(docs, n=4, percent=85):
    sets = {k: shingle_set(t, n) for k, t in docs}
    top = {k: k for k in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                top[max(p, q)] = min(p, q)
    return {k: (len(sets[k]), find(k)) for k in keys}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def edited(text, share, r):
    w = text.split()
    for i in range(len(w)):
        if r.random() < share:
            w[i] = f"w{r.randrange(10 ** 6)}"
    return " ".join(w)


def test_groups_and_stars_equal_brute_force(spark):
    r = random.Random(11)
    docs, k = [], 0
    for g in range(6):
        base = prose(100 + g, r.choice([3, 12, 60, 200]))
        for share in [0] * 3 + [.005] * 8 + [.015] * 12 + [.03] * 8:
            docs.append((k * 7 % 1009, edited(base, share, r)))
            k += 1
    passage = prose(50, 40)
    docs += [(2000 + i, prose(300 + i, 60) + " " + passage) for i in range(40)]
    docs += [(3000 + i, " ".join(["same few words here"] * (i + 1))) for i in range(9)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert result(jaccard_components(df)) == brute(docs)
    assert result(jaccard_components(df, n=2, percent=60)) == brute(docs, 2, 60)


def test_chains_beyond_the_pivot(spark):
    """Links between documents that are not linked with the pivot are found."""
    w = [f"t{i}" for i in range(400)]
    docs = [(i, " ".join(w[4 * i:4 * i + 200])) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert result(jaccard_components(df)) == brute(docs)


def test_awkward_rows(awkward, empty):
    rows = awkward.select("doc_id", "text").collect()
    want = brute([(r["doc_id"], r["text"]) for r in rows if r["doc_id"] is not None])
    got = sorted(jaccard_components(awkward).collect(), key=key_of)
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["n_shingles"] > 0
        else:
            assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
    assert jaccard_components(empty).count() == 0


def test_components(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(300, 400)] + [(999, i) for i in range(50)] + \
        [(r.randrange(500, 700), r.randrange(500, 700)) for _ in range(90)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    top = {x: x for e in edges for x in e if None not in e}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in edges:
        if a is not None:
            top[max(find(a), find(b))] = min(find(a), find(b))
    got = {r["node"]: r["component"] for r in components(df).collect()}
    assert got == {x: find(x) for x in top}
    assert components(df.limit(0)).count() == 0
