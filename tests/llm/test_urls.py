"""Op 13: listed rules, mined rules against counting every set of tokens, awkward rows."""

import random
import re
from collections import Counter
from itertools import combinations

from rankloom.llm.urls import RULES, filter_urls, mine

PAGES = "page_id long, url string, html string, host string, token string, body string, n int"
LABELS = "doc_id long, quality int, toxic int, id long, bad string"


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def parts(url):
    if url is None or "://" not in url:
        return "", "", frozenset()
    rest = url.split("://", 1)[1]
    host = lower(re.match(r"[^/?#]*", rest)[0])
    before, _, query = re.match(r"[^#]*", rest)[0].partition("?")
    path = before[len(host):]
    return host, path, frozenset(
        [f"h:{x}" for x in host.split(".") if x]
        + [f"p:{lower(x)}" for x in re.split("[/.]", path) if x]
        + [f"q:{lower(k)}" for k in (x.split("=")[0] for x in query.split("&")) if k])


def brute(pages, labels, least, confidence):
    bad = {}
    for d, q, t, *_ in labels:
        if q in (0, 1) or t == 1:
            bad[d] = bad.get(d, False) or q == 0 or t == 1
    all_, bads = Counter(), Counter()
    for pid, url, *_ in pages:
        if pid is not None and pid in bad:
            ts = sorted(parts(url)[2])
            for k in range(1, len(ts) + 1):
                for body in combinations(ts, k):
                    all_[body] += 1
                    bads[body] += bad[pid]
    rules = []
    for body, n in all_.items():
        for s, block in ((bads[body], True), (n - bads[body], False)):
            if s >= least and s / n >= confidence:
                rules.append((set(body), (s / n, s, block)))
    out = Counter()
    for pid, url, *_ in pages:
        host, path, ts = parts(url)
        fits = [(len(h + p), h + p, v) for h, p, v in RULES
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict, best = None, "allow", None
        if fits:
            _, rule, verdict = max(fits)
        elif met := [r for b, r in rules if b <= ts]:
            best = max(met)
            verdict = "block" if best[2] else "allow"
        out[pid, host, path, rule, verdict, *(best[:2] if best else (None, 0))] += 1
    return out


def test_verdicts(spark):
    r = random.Random(5)
    hosts = ["good.example.org", "spam.example.org", "Mixed.Example.com", "x.net", "plain.info",
             "a.example.net", "example.net"]
    pages, labels = [], []
    for i in range(700):
        h = r.choice(hosts)
        sec = r.choice(["en", "fr", "de", "Shop", "promo.html"])
        url = f"https://{h}/{sec}/{i}" + r.choice(["", "?page=2&ref=x", "#top", "?ad=1"])
        pages.append((i, url, "t", "k", "k", "k", 1))
        bad = "spam" in h or (sec == "Shop" and "ad=1" in url) or r.random() < .05
        if r.random() < .8:
            labels.append((i, int(not bad), r.choice([0, None]), 1, "b"))
    odd = [None, "", "no scheme", "http://", "https://?x=1", "HTTPS://EXAMPLE.com/de", "a://b://c/d",
           "http://org/fr/", "http://xorg/fr/", "http://Example.NET/en/x", "http://example.net",
           "http://a.b.example.com/de/x?y#z", "x://h/" + "é" * 40_000, "http://h?a&=b&c=&a=1"]
    pages += [(1000 + i, u, None, None, None, None, None) for i, u in enumerate(odd)]
    pages += [(None, "http://spam.example.org/en/1", "", "", "", "", 0)] * 2 + pages[:3]
    labels += [(3, 0, 0, 1, ""), (3, 1, 0, 1, ""), (None, 0, 1, 1, ""), (5, None, None, 1, ""),
               (7, None, 1, 1, ""), (9, 2, 0, 1, "")]
    want = brute(pages, labels, 5, .8)
    p, q = spark.createDataFrame(pages, PAGES), spark.createDataFrame(labels, LABELS)
    got = Counter(tuple(x) for x in filter_urls(p, q, support=.001, least_pages=5).collect())
    assert got == want, str((list((got - want).items())[:3], list((want - got).items())[:3]))
    assert sum(n for k, n in want.items() if k[3] is None and k[4] == "block") > 50


def test_long_url_with_many_labels_is_one_item(spark):
    url = "http://deep.info/" + "/".join(f"part{i}" for i in range(60))
    p = spark.createDataFrame([(i, url) for i in range(40)], "page_id long, url string")
    q = spark.createDataFrame([(i, 0, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    rules, known = mine(p, q)
    assert [(r["support"], r["confidence"], r["block"]) for r in rules.collect()] == [(40, 1.0, True)]
    assert known.select("item").distinct().count() == 1
    assert {r["verdict"] for r in filter_urls(p, q).collect()} == {"block"}


def test_empty(spark):
    p, q = spark.createDataFrame([], PAGES), spark.createDataFrame([], LABELS)
    assert filter_urls(p, q).count() == 0
    some = spark.createDataFrame([(1, "http://spam.io/x")], "page_id long, url string")
    assert [tuple(r) for r in filter_urls(some, q).collect()] == [
        (1, "spam.io", "/x", None, "allow", None, 0)]
