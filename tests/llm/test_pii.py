"""Op 10: base kinds against the contract's expressions, added kinds, redaction."""

import hashlib
import random
import re

from rankloom.llm import pii as P


def brute(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
        if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m[0])
        twice = "".join(str(int(c) * (1 + i % 2)) if int(c) * (1 + i % 2) < 10 else
                        str(int(c) * 2 - 9) for i, c in enumerate(reversed(d)))
        if 12 <= len(d) <= 19 and sum(map(int, twice)) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_base_kinds():
    r = random.Random(51)
    pieces = list("@@..--++ ()0123456789ab%_é\n٣") + [
        "a@b.c", "1.2.3.4", "4111 1111 1111 1111", "+1 (234) 567-8901", "256.1.1.1"]
    for _ in range(20_000):
        t = "".join(r.choices(pieces, k=r.randint(0, 50)))
        assert [(s, i, e) for s, i, _, e in P.find(t) if i < 4] == brute(t)


def test_long_runs_are_linear():
    for t in ("1" * 200_000, "a" * 200_000, "1." * 100_000, "@" * 100_000, "a@" * 100_000,
              "+1" * 100_000, "+" + "1." * 100_000, "password=" * 20_000, "." * 200_000):
        P.find(t)


def test_added_kinds():
    t = ("IBAN: DE89 3704 0044 0532 0130 00, iban GB00 1234 5678 9012 3456 78; "
         "Account no: 12-345678 password=s3cretpw! see https://me:pw@host.example/x")
    got = [(k, t[s:e]) for s, _, k, e in P.find(t)]
    assert ("iban", "DE89 3704 0044 0532 0130 00") in got and ("account", "12-345678") in got
    assert ("secret", "s3cretpw!") in got and not [x for x in got if x[1].startswith("GB00")]
    assert ("url", "https://me:pw@host.example/x") in got
    assert ("email", "pw@host.example") in got            # base spans stay


def test_awkward_rows(awkward, empty):
    rows = P.find_pii(awkward).collect()
    assert len(rows) == awkward.count()
    texts = {r["doc_id"]: r["text"] or "" for r in awkward.collect()}
    for r in rows:
        want = brute(texts[r["doc_id"]])
        joined = ",".join(f"{P.BASE[k]}:{s}:{e}" for s, k, e in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in P.BASE] == [sum(x[1] == i for x in want) for i in range(4)]
    by = {r["doc_id"]: r for r in rows}
    assert (by[17]["n_email"], by[17]["n_ip"], by[17]["n_card"], by[17]["n_phone"]) == (1, 1, 1, 1)
    assert by[0]["spans"] == "" and P.find_pii(empty).count() == 0
    red = P.redact(awkward)
    assert red.columns == awkward.columns
    t = {r["doc_id"]: r["text"] for r in red.collect()}
    assert t[0] is None and t[17] == "mail [email] or [phone], [ip], [card]"


def test_long_secrets_and_ibans_before_capitals():
    token = "eyJ" + "a1B2." * 200 + "end"
    t = f"token={token}, IBAN: DE89370400440532013000 BIC COBADEFF and iban DE89 3704 0044 0532 0130 00 BIC"
    got = [(k, t[s:e]) for s, _, k, e in P.find(t)]
    assert ("secret", token) in got and ("iban", "DE89370400440532013000") in got
    assert ("iban", "DE89 3704 0044 0532 0130 00") in got


def test_long_accounts_and_cues_in_any_case():
    number = "A1" * 22
    t = f"account number: {number}, PassWord: hunter2hunter, \u0130 aCCt no: 12345678"
    got = [(k, t[s:e]) for s, _, k, e in P.find(t)]
    assert got == [("account", number), ("secret", "hunter2hunter"), ("account", "12345678")]
