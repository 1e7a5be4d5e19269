"""Op 1 against brute force over all strings."""

import hashlib
import random

import numpy as np

from rankloom.llm import substrings as S
from tests.llm.conftest import key_of


def brute(docs, length=100):
    """docs: (key, bytes), a key once; the contract word by word."""
    seen, out = set(), {}
    for key, t in sorted(docs):
        gone = bytearray(len(t))
        for s in range(len(t) - length + 1):
            if t[s:s + length] in seen:
                gone[s:s + length] = b"\1" * length
            seen.add(t[s:s + length])
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[key] = (len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def result(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
            for r in df.collect()}


def test_repetitive_texts_equal_brute_force(spark):
    r = random.Random(7)
    passages = ["".join(r.choices("ab", k=r.randint(60, 400))) for _ in range(12)]
    docs = [(i, "".join(r.choice(passages) if r.random() < .7 else
                        "".join(r.choices("abcdé\n", k=r.randint(0, 150)))
                        for _ in range(r.randint(0, 8)))) for i in range(120)]
    docs += [(500, "a" * 3000), (501, "a" * 150), (502, "ab" * 900), (503, "z" * 99)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert result(S.remove_repeats(df)) == brute([(k, t.encode()) for k, t in docs])


def test_small_chunks_and_flushes_change_nothing(spark, monkeypatch):
    r = random.Random(8)
    passages = ["".join(r.choices("abc", k=300)) for _ in range(4)]
    docs = [(i, "".join(r.choice(passages) for _ in range(6))) for i in range(40)]
    buf, first = S.join([t.encode() for _, t in docs])
    whole = S.parse(buf, first[:-1], first[1:] - 100)
    assert sum(int(n) for n in whole[3]) == sum(len(t) - 99 for _, t in docs)
    monkeypatch.setattr(S, "CHUNK", 512)
    parts = S.parse(buf, first[:-1], first[1:] - 100)
    assert sum(int(n) for n in parts[3]) == sum(int(n) for n in whole[3])


def test_equal_windows_have_equal_cores():
    r = random.Random(9)
    same = "".join(r.choices("abcd ", k=400))
    texts = [("".join(r.choices("abcd ", k=r.randint(0, 200))) + same
              + "".join(r.choices("abcd ", k=50))).encode() for _ in range(6)]
    cores = []
    for t in texts:
        buf, first = S.join([t])
        core, _, start, size = S.parse(buf, first[:-1], first[1:] - 100)
        at = t.index(same.encode())
        of = np.repeat(core, size)          # starts are consecutive from 0
        assert start[0] == 0 and len(of) == len(t) - 99
        cores.append(of[at:at + 301].tolist())
    assert all(c == cores[0] for c in cores)


def test_awkward_rows(awkward, empty):
    rows = sorted(awkward.select("doc_id", "text").collect(), key=key_of)
    one = {r["doc_id"] if r["doc_id"] is not None else -1: (r["text"] or "").encode()
           for r in rows}
    want = brute(list(one.items()))
    got = S.remove_repeats(awkward).collect()
    assert len(got) == len(rows)
    for r in got:
        key = -1 if r["doc_id"] is None else r["doc_id"]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[key]
    assert S.remove_repeats(empty).count() == 0


def test_kept_text(spark):
    df = spark.createDataFrame([(1, "q" * 99 + "é"), (2, "xy" + "q" * 99 + "é!")],
                               "doc_id long, text string")
    kept = {r["doc_id"]: bytes(r["kept"]) for r in S.remove_repeats(df, with_text=True).collect()}
    assert kept[1] == ("q" * 99 + "é").encode() and kept[2] == b"xy!"
