"""Op 12: the trie against a plain one, parentheses against a stack, small blocks and shards."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from rankloom.llm import trie
from rankloom.llm.trie import BLOCK, Parentheses, encode, prefix_trie, subtree_sums

SCHEMA = "conv_id long, turn long, role string, text string, n int, owner string, path string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    def order(x):
        d = hashlib.md5(f"{len(x[2])}:{x[2]}{x[3]}".encode()).hexdigest()
        return x[0], x[1], int(d[:15], 16), int(d[15:30], 16)

    own = {c: [x[2:] for x in sorted(v, key=order)] for c, v in own.items()}
    members = defaultdict(list)
    full = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        full[c] = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(full[c]) + 1):
            members[full[c][:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out = Counter()
    saved, leaves = {}, {}
    for p in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        saved[p] = (len(members[p]) - 1) * words + sum(saved[x] for x in children[p])
        leaves[p] = sum(leaves[x] for x in children[p]) or 1
        ends = ",".join(str(c) for c in sorted(c for c in members[p] if full[c] == p))
        out[min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]),
            len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def conversations(seed, n):
    r = random.Random(seed)
    texts = ["", "a", "b c", "hello there  you", "d e f g", None, "é  x", "x" * 9000 + " y"]

    def turn():
        return r.choice(["user", "assistant", None, ""]), r.choice(texts)

    pool = [[turn() for _ in range(r.randint(1, 9))] for _ in range(6)]
    rows = []
    for c in r.sample(range(-50, 4 * n), n):
        body = list(r.choice(pool)) if r.random() < .7 else [turn() for _ in range(r.randint(1, 6))]
        if r.random() < .4:
            body = body[:r.randint(1, len(body))] + [turn() for _ in range(r.randint(0, 3))]
        at = 0
        for role, text in body:
            rows.append((c, None if r.random() < .03 else at, role, text, 1, "o", "p"))
            at += r.choice([0, 1, 1, 1, 5000])
    return rows


@pytest.mark.parametrize("block", [BLOCK, 7])
def test_nodes(spark, monkeypatch, block):
    monkeypatch.setattr(trie, "BITS", 1 if block == 7 else 12)
    rows = conversations(block, 300)
    rows += [(None, 0, "user", "a", 1, "", ""), *rows[:4], (7000, None, None, None, 1, "", "")]
    rows += [(c, t, "user", f"w{t} v", 1, "", "") for c in (8000, 8001, 8020, 8040)
             for t in range(60)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = Counter(tuple(x) for x in prefix_trie(df, block, 3 if block == 7 else 1000).collect())
    want = brute(rows)
    assert got == want, str((list((got - want).items())[:3], list((want - got).items())[:3]))


def test_equal_conversations_and_empty_tables(spark):
    rows = [(c, t, "user", f"turn {t}", 1, "", "") for c in range(90) for t in range(5)]
    got = Counter(tuple(x) for x in prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == brute(rows)
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_parentheses():
    r = random.Random(3)
    for n in (1, 2, 5, 40, 300, 3000):
        depth, lens, common = 0, [], []
        for _ in range(n):
            shared = r.randint(0, depth) if r.random() < .8 else depth
            depth = shared + r.randint(0 if lens and shared else 1, 4)
            lens.append(depth)
            common.append(shared if len(lens) > 1 else 0)
        lens, common = np.array(lens), np.array(common)
        lens[0] = max(lens[0], 1)
        size = int((lens - common).sum())
        leaves = np.array([r.choice([0, 0, 1, 3]) for _ in range(size)])
        weight = np.array([r.randint(0, 9) for _ in range(size)])
        bits, start = encode(lens, common, leaves)
        stack, close = [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                close[stack.pop()] = i
        assert not stack
        marks = Parentheses(bits)
        every = np.flatnonzero(bits)
        assert marks.find_close(every).tolist() == [close[i] for i in every.tolist()]
        got = subtree_sums(bits, start, leaves, weight)
        for i, s in enumerate(start.tolist()):
            inside = (start >= s) & (start < close[s])
            assert (got[0][i], got[1][i]) == (leaves[inside].sum(), weight[inside].sum())
