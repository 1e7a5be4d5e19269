"""Small tables with every awkward case: nulls in any column, empty and very long texts,
ties and repeated rows, an empty table, further columns whose names operators use inside."""

import random
import re

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, k string, z int, "
          "block int, node string, kept string, score string, line string")

WORDS = "alpha beta gamma delta omega river stone cloud Ärger straße cañón niño über maß".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choices("abcdefghijklmnop", k=r.randint(2, 9))) if r.random() < .5
                    else r.choice(WORDS) for _ in range(n))


def awkward_rows():
    long = prose(1, 30_000)
    base = prose(2, 120)
    near = base.replace(base.split()[60], "changed", 1)
    texts = [None, "", " \n\t ", "one", "two words", "123 456 ²", base, base, near, long,
             "x" * 70_000, "ab" * 400, "a b a b " * 200, base + "\n" + base,
             "Line one stands here for all.\n\nLine one stands here for all.\n",
             prose(3, 40) + "\n" + prose(4, 50), prose(3, 40) + "\r\n" + "tail",
             "mail me@x.example.com or +49 (30) 123456-78, 10.0.0.255, 4111 1111 1111 1111"]
    rows = [(i, t, ["en", "de", None][i % 3], f"s{i % 2}" if i % 5 else None,
             len(t) if t else None) for i, t in enumerate(texts)]
    rows.append(rows[6])                                    # a repeated row
    rows.append((None, prose(5, 30), "en", None, None))     # a null key
    rows.append((900, base, None, None, None))
    return [r + ("k", 1, 2, "n", "kept", "s", "l") for r in rows]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def key_of(row):
    return (row["doc_id"] is not None, row["doc_id"] or 0)
