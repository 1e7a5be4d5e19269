"""Op 11: against the two libraries and a plain count, with long texts over many chunks."""

import functools
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from rankloom.llm.alignment import (Fragment, Streams, Tokenizers, align, chunks, compose,
                                    fragment)
from tests.llm.conftest import awkward_rows, prose

A, B = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@functools.cache
def tok():
    with open(A, "rb") as f, open(B, "rb") as g:
        return Tokenizers(f.read(), g.read())


def brute(rows):
    t, docs = tok(), []
    for key, text in rows:
        if not text:
            docs.append((key, None))
            continue
        a, b = (x[0].tolist() for x in (t.encode_a([" " + text]), t.encode_b([text])))
        spell = [b"".join(table.spell(np.array([i])).tobytes() for i in ids)
                 for table, ids in ((t.a, a), (t.b, b))]
        docs.append((key, (a, b) if spell == [(" " + text).encode()] * 2 else None))
    out, linked = [], []
    for key, both in docs:
        if both is None:
            out.append((key, 0, 0, 0, [], ""))
            linked.append([])
            continue
        a, b = both
        ends = [np.cumsum(t.a.length[a]).tolist(), np.cumsum(t.b.length[b]).tolist()]
        common = sorted(set(ends[0]) & set(ends[1]))
        groups, i, j, pairs = [], 0, 0, []
        for e in common:
            ni, nj = ends[0].index(e, i) + 1, ends[1].index(e, j) + 1
            groups.append(",".join(map(str, a[i:ni])) + "|" + ",".join(map(str, b[j:nj])))
            for x in range(i, ni):
                for y in range(j, nj):
                    lo = max(ends[0][x - 1] if x else 0, ends[1][y - 1] if y else 0)
                    if lo < min(ends[0][x], ends[1][y]):
                        pairs.append((a[x], b[y]))
            i, j = ni, nj
        out.append((key, len(a), len(b), len(groups), pairs,
                    hashlib.sha256(";".join(groups).encode()).hexdigest()))
        linked.append(pairs)
    total = Counter(p for ps in linked for p in ps)
    top = Counter()
    for (x, y), n in total.items():
        top[y] = max(top[y], n)
    return Counter((k, na, nb, ng, len(ps), sum(total[p] == top[p[1]] for p in ps),
                    sum(total[p] for p in ps), sha) for k, na, nb, ng, ps, sha in out)


def texts():
    r = random.Random(9)
    odd = ["a", " ", "  two  spaces ", "\n\n x\t\ty \n z", "▁", "a▁b", "<s> </s><unk> <|endoftext|>",
           "\x00\x01", "日本語の文章です。" * 30, "naïve café ÀÉÎ", "é " * 40, "x  y　 z  ",
           "don't we'll I'M", "🎉🎉 ok 👩‍👩‍👧", "1234567 89 ٣٤", "a" * 700, "end with space ", "\x1c \x85 a"]
    return odd + [prose(r.randrange(999), r.randint(1, 40)) for _ in range(20)]


@pytest.mark.parametrize("chunk,block,fan", [(64 << 10, 6 << 20, 16), (48, 500, 2), (7, 64, 3)])
def test_against_the_libraries(spark, chunk, block, fan):
    rows = list(enumerate(texts())) + [(0, texts()[20]), (None, texts()[21]), (99, None), (99, "")]
    rows += [r[:2] for r in awkward_rows()[:16] if chunk > 100 or len(r[1] or "") < 2000]
    df = spark.createDataFrame([(k, t, 1, "w") for k, t in rows],
                               "doc_id long, text string, rid int, whole string").repartition(3)
    got = Counter(tuple(x) for x in align(df, A, B, chunk=chunk, block=block, fan=fan).collect())
    want = brute(rows)
    assert got == want, str((list((got - want).items())[:3], list((want - got).items())[:3]))


def test_empty(spark):
    assert align(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0


def same(f, g):
    def plain(s):
        return s.a.tolist(), s.b.tolist(), (s.a_at, s.b_at) if len(s.a) or len(s.b) else None
    return (f.cut, f.ok, plain(f.head), plain(f.tail)) == (g.cut, g.ok, plain(g.head), plain(g.tail))


def test_composition_is_associative():
    t = tok()
    for i, text in enumerate(texts() + [prose(7, 300)]):
        data = (" " + text).encode()
        parts = []
        for j, (a0, a1, b0, b1) in enumerate(chunks(data, 5 + i % 9, t.apart)):
            a = t.encode_a([data[a0:a1].decode()])[0]
            b = t.encode_b([data[b0 + 1:b1].decode()])[0] if b1 > b0 else np.zeros(0, np.int64)
            f, done = fragment(Streams(a0, a, b0, b), True, False, t)
            parts.append((f, [] if done is None else [done]))

        def join(x, y):
            f, done = compose(x[0], y[0], t)
            return f, x[1] + ([done] if done is not None else []) + y[1]

        for k in range(len(parts) - 2):
            x, y, z = parts[k:k + 3]
            one, two = join(join(x, y), z), join(x, join(y, z))
            assert same(one[0], two[0])
            assert [sum(len(s.a) for s in r[1]) for r in (one, two)][0] == sum(
                len(s.a) for s in two[1])
            flat = [np.concatenate([s.a for s in r[1]] or [np.zeros(0, np.int64)]).tolist()
                    for r in (one, two)]
            assert flat[0] == flat[1]
    assert isinstance(parts[0][0], Fragment)
