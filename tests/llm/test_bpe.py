"""Ops 3 and 4 against the tokenizers library."""

import hashlib
import random

import public_tokenizers
from tokenizers import Tokenizer

from rankloom.llm import bpe
from rankloom.llm.token_counts import Counter, token_counts
from rankloom.llm.vocabulary import read

PATH = public_tokenizers.path("byte_bpe_50k.json")

PIECES = ["a", "b", "e", "t", "h", " ", "  ", "\n", "\t", "\x85", "\x1c", "é", "ß", "1", "23",
          ".", ",", "the", "ing", " th", "\x00", "Ω", "ж", "—", "'s", "'ll", "中", "́",
          "\U0001F600", "<|endoftext|>", "<|endof", "_", "‍", "　", "﻿"]


def odd_texts():
    r = random.Random(4)
    return (["", " ", "\n\n  a", "a" * 3000, " " * 900 + "x", "ab" * 700, "0" * 301, "=-" * 99]
            + ["".join(r.choices(PIECES, k=r.randint(1, 120))) for _ in range(400)]
            + ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(1, 40)))
               for _ in range(2000)])


def test_ids_text_and_counts_equal_the_library():
    library, codec, counter = Tokenizer.from_file(PATH), bpe.Codec(read(PATH)), Counter(read(PATH))
    texts = odd_texts()
    want = library.encode_batch(texts, add_special_tokens=False)
    ids, joined = codec.encode(texts)
    assert [x.tolist() for x in ids] == [e.ids for e in want]
    assert joined == [",".join(map(str, e.ids)) for e in want]
    assert [codec.decode(x) for x in ids] == [
        library.decode(e.ids, skip_special_tokens=False) for e in want]
    assert counter.count(texts) == [len(e.ids) for e in want]


def test_a_cut_id_sequence_decodes_like_the_library():
    library, codec = Tokenizer.from_file(PATH), bpe.Codec(read(PATH))
    ids, _ = codec.encode(["日本 \U0001F600 ж"])
    for n in range(len(ids[0])):
        assert codec.decode(ids[0][:n]) == library.decode(ids[0][:n].tolist())


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    codec, library = bpe.Codec(read(PATH)), Tokenizer.from_file(PATH)
    for t in ["some words stand here", "other words stand there", "some words stand here"]:
        assert codec.encode([t])[0][0].tolist() == library.encode(t).ids


def test_tables(awkward, empty):
    library = Tokenizer.from_file(PATH)
    rows = awkward.select("doc_id", "text").collect()
    want = sorted((str(r["doc_id"]), library.encode(r["text"] or "", add_special_tokens=False).ids,
                   r["text"] or "") for r in rows)
    got = sorted(map(tuple, bpe.round_trip(awkward, PATH).collect()), key=str)
    assert got == sorted(((None if k == "None" else int(k), len(i), hashlib.sha256(
        ",".join(map(str, i)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
        for k, i, t in want), key=str)
    counts = sorted(map(tuple, token_counts(awkward, PATH).collect()), key=str)
    assert counts == sorted(((None if k == "None" else int(k), len(t.encode()), len(i),
                              len(i) > 512) for k, i, t in want), key=str)
    encoded = bpe.encode(awkward, PATH)
    texts = bpe.decode(encoded, PATH)
    assert sorted(str(tuple(r)) for r in texts.collect()) == sorted(
        str((None if k == "None" else int(k), t)) for k, _, t in want)
    for f in (bpe.round_trip, token_counts, bpe.encode):
        assert f(empty, PATH).count() == 0
    assert bpe.decode(encoded.limit(0), PATH).count() == 0
