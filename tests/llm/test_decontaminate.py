"""Op 6 against brute force, and the index on its own."""

import hashlib
import random
import re

import numpy as np

from rankloom.llm import decontaminate as D
from tests.llm.conftest import words_of

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def brute(texts, items, window=10):
    found = {}
    for item, t in items:
        w = words_of(t, WORD)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            found.setdefault(tuple(w[i:i + window]), set()).add(item)
    sizes, out = {len(p) for p in found}, []
    for t in texts:
        w, hit, names = words_of(t, WORD), set(), set()
        for i in range(len(w)):
            for n in sizes:
                if (p := tuple(w[i:i + n])) in found and len(p) == n:
                    names |= found[p]
                    hit |= set(range(i, i + n))
        out.append((len(w), len(hit), len(names),
                    hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return out


def random_case(r):
    letters = ["a", "b", "c", "D", "é", "7"][:r.randint(1, 6)]

    def text(n):
        return "".join(r.choice(letters) + r.choice([" ", "  ", "-", "", "\n"])
                       for _ in range(r.randint(0, n)))

    return ([text(80) for _ in range(r.randint(1, 9))] + ["", None],
            [(str(r.randint(0, 9)), text(40)) for _ in range(r.randint(0, 8))])


class Block:
    def __init__(self, value):
        self.value = value


def test_random_texts_in_one_and_many_blocks():
    r = random.Random(31)
    for _ in range(150):
        texts, items = random_case(r)
        window, blocks = r.choice([1, 2, 3, 10]), r.choice([1, 2, 3])
        s = D.Searcher([Block((window, [x for x in items if int(x[0]) % blocks == b]))
                        for b in range(blocks)])
        words, covered, names = s.search(texts)
        got = [(int(n), int(h), len(i), hashlib.sha256(",".join(sorted(i)).encode()).hexdigest(),
                h > 0) for n, h, i in zip(np.bincount(words.doc, minlength=len(texts)),
                                          np.bincount(words.doc[covered], minlength=len(texts)),
                                          names)]
        assert got == brute(texts, items, window)


def test_index_counts_and_locates():
    r = random.Random(32)
    seq = np.array([r.randint(1, 3) if r.random() < .93 else 0 for _ in range(700)] + [0])
    index, text = D.FMIndex(seq.copy()), seq.tolist()
    p = D.Patterns([], 3)
    grams = sorted({tuple(text[i:i + n]) for n in (1, 2, 3) for i in range(700)
                    if 0 not in text[i:i + n]} | {(3, 3, 3), (1, 1, 1)})
    p.size = np.array([len(g) for g in grams])
    p.word = np.zeros((len(grams), 3), np.int64)
    for k, g in enumerate(grams):
        p.word[k, :len(g)] = g[::-1]
    which, low, high = index.search(p)
    for k, a, b in zip(which, low, high):
        g = grams[k]
        want = [i for i in range(len(text)) if tuple(text[i:i + len(g)]) == g]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want
    assert {grams[k] for k in which} == {g for g in grams if any(
        tuple(text[i:i + len(g)]) == g for i in range(len(text)))}


def test_tables(spark, awkward, empty):
    base = awkward.filter("doc_id = 6").first()["text"].split()
    items = [(1, " ".join(base[10:30])), (2, re.sub("[a-z]", lambda m: m[0].upper(), " ".join(base[25:33]))), (2, "two words"),
             (None, " ".join(base[50:61])), (3, None), (4, "!!"), (5, "one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = awkward.select("doc_id", "text").collect()
    named = [("null" if i is None else str(i), t) for i, t in items]
    want = sorted(zip([str(r["doc_id"]) for r in rows],
                      brute([r["text"] for r in rows], named)))
    for b in (awkward, awkward.repartition(3)):
        got = sorted((str(r[0]), tuple(r[1:])) for r in D.contamination(b, bench).collect())
        assert got == want
    assert D.contamination(empty, bench).count() == 0
    assert D.contamination(awkward, bench.limit(0)).filter("contaminated").count() == 0
    clean = D.clean(awkward, bench)
    assert clean.columns == awkward.columns and clean.count() == len(rows)
    left = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert left[0] is None and left[3] == "" and left[10] == "x" * 70_000
    kept = words_of(left[6], WORD)
    assert len(kept) == len(base) - 23 - 11 and re.search(r"\S", left[6])
    again = D.contamination(clean, bench).filter("contaminated").select("doc_id").collect()
    assert not [r for r in again if r[0] == 6]
