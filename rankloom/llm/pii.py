"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, address schemes and cues of
identifiers and credentials.  A deterministic parser at each anchor expands to the left
and right to the borders of the email address, credentialed address, account number or
credential, and validates it.  Digit-led kinds (IP, card, phone) have the digits themselves
as anchors and a parser that reads on from them.  No parser looks back over what its kind
has consumed, so the work is linear in the text.

Kinds, in the order used for spans that start together: email, ip, card, phone (the base);
url (address with user information), iban (valid check digits), account (identifier after
its cue), secret (credential after its cue).  The added kinds never remove a base span.

Defined results: a null or empty text has no spans (``base_sha256`` of the empty string);
offsets are code points of the whole text, end exclusive; equal rows give equal results;
further columns of the input are kept off.
"""

from __future__ import annotations

import functools
import hashlib
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from rankloom.llm.common import LOWER, UPPER

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "iban", "account", "secret")

# Anchors and what they announce.
AT = "@"
SCHEMES = ("http://", "https://", "ftp://", "sftp://", "ssh://", "ldap://", "smtp://",
           "imap://", "mongodb://", "mysql://", "postgres://", "postgresql://", "redis://")
ACCOUNT_CUES = ("account", "acct", "passport", "ssn", "social security", "tax id",
                "customer id", "user id", "member id", "license no", "routing")
SECRET_CUES = ("password", "passwd", "pwd", "secret", "api_key", "api-key", "apikey",
               "access_key", "access-key", "auth_token", "token")
IBAN_CUE = "iban"

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
USER_INFO = re.compile(r"[^\s/@:]+:[^\s/@]+@[A-Za-z0-9.-]+(?::[0-9]+)?(?:/\S*)?")
IBAN = re.compile(r"[\s:#=]{0,8}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{2,4}){3,9})")
ACCOUNT = re.compile(r"(?:[\s_-]{0,3}(?:number|no\.?|nr\.?|num|id|#))?[\s]{0,3}[:=#][\s]{0,3}"
                     r"([A-Za-z0-9][A-Za-z0-9-]{4,}+)")
SECRET = re.compile(r"[\"']?[\s]{0,3}[:=][\s]{0,3}[\"']?([^\s\"',;]{6,})")


@functools.cache
def anchors() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()

    def cue(word: str, what: str) -> None:
        a.add_word(word, (what, len(word)))

    cue(IBAN_CUE, "iban")
    for kind, words in (("account", ACCOUNT_CUES), ("secret", SECRET_CUES), ("url", SCHEMES)):
        for w in words:
            cue(w, kind)
    a.add_word(AT, ("email", 1))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def iban_holds(value: str) -> bool:
    s = value.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(
        str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def _iban(text: str, start: int, end: int) -> tuple[int, int] | None:
    """The longest reading that holds and ends where a group does: at ``end`` or before a space."""
    while end > start:
        if iban_holds(text[start:end]):
            return start, end
        end = text.rfind(" ", start, end)
    return None


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around the at-sign at ``at`` that begins no earlier than ``floor``."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    m = DOMAIN.match(text, at + 1) if start < at else None
    return (start, m.end()) if m else None


def _digits(text: str):
    """Base kinds led by digits: leftmost, not overlapping within a kind; a reading that
    fails its check is consumed and dropped."""
    for m in IP.finditer(text):
        if all(len(p := x.lstrip("0")) < 4 and int(p or 0) <= 255 for x in m[0].split(".")):
            yield "ip", m.start(), m.end()
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield "card", m.start(), m.end()
    for m in PHONE.finditer(text):
        if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
            yield "phone", m.start(), m.end()


TO_LOWER = str.maketrans(UPPER, LOWER)      # cues count in any case; offsets stay
HAS_DIGIT = re.compile("[0-9]")


def find(text: str) -> list[tuple[int, int, str, int]]:
    """(start, index of kind, kind, end) of every span, in order."""
    found: list[tuple[str, int, int]] = []
    floor = dict.fromkeys(("email", "url", "iban", "account", "secret"), 0)
    for last, (what, size) in anchors().iter(text.translate(TO_LOWER)):
        span, at = None, last - size + 1
        if what == "email":
            span = _email(text, at, floor["email"])
        elif at < floor[what]:
            continue
        elif what == "url":
            if m := USER_INFO.match(text, last + 1):
                span = (at, m.end())
        elif what == "iban":
            if m := IBAN.match(text, last + 1):
                span = _iban(text, *m.span(1))
        elif what == "account":
            if (m := ACCOUNT.match(text, last + 1)) and sum(c in "0123456789" for c in m[1]) >= 4:
                span = m.span(1)
        elif m := SECRET.match(text, last + 1):
            span = m.span(1)
        if span:
            floor[what] = span[1]
            found.append((what, *span))
    if HAS_DIGIT.search(text):
        found.extend(_digits(text))
    return sorted((s, KINDS.index(k), k, e) for k, s, e in found)


def _joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in spans)


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row."""
    def run(batches):
        for batch in batches:
            rows = [find(t) if t else [] for t in batch.column(text).to_pylist()]
            base = [[x for x in r if x[2] in BASE] for r in rows]
            counts = [pa.array([sum(x[2] == k for x in b) for b in base], pa.int64())
                      for k in BASE]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), *counts,
                 pa.array([hashlib.sha256(_joined(b).encode()).hexdigest() for b in base]),
                 pa.array([_joined(r) for r in rows], pa.string())],
                [key, *(f"n_{k}" for k in BASE), "base_sha256", "spans"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, " + "".join(f"n_{k} long, " for k in BASE)
        + "base_sha256 string, spans string")


def redact(docs: DataFrame, text: str = "text", mark: str = "[{}]") -> DataFrame:
    """The same rows and columns with every span replaced by its kind (of overlapping
    spans the one that starts first, then the longer); a null text stays null."""
    def clean(t: str | None) -> str | None:
        if not t:
            return t
        out, at = [], 0
        for s, _, k, e in sorted(find(t), key=lambda x: (x[0], -x[3])):
            if s >= at:
                out += [t[at:s], mark.format(k)]
                at = e
        return "".join(out) + t[at:]

    place = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            new = pa.array([clean(t) for t in batch.column(place).to_pylist()], pa.string())
            cols = [new if i == place else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(cols, batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
