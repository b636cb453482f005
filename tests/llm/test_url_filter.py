import hashlib
import math
import random
import re
from collections import Counter

import duckdb

from gleanery.llm import url_filter as U


def parts(url):
    url = url or ""
    if "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]+", lambda m: m[0].lower(), host), path


def rule_of(host, path):
    best = None
    for kind, h, p in U.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, kind)
    return best


def unseen(u):
    return int(hashlib.md5(u.encode()).hexdigest()[:8], 16) % 5 == 0


def brute(urls):
    ruled = [(u or "", rule_of(*parts(u))) for u in urls]
    train = [(u, r[1] == "allow") for u, r in ruled if r and not unseen(u)]
    check = [(u, r[1] == "allow") for u, r in ruled if r and unseen(u)]
    if len({r[1] for _, r in ruled if r}) < 2:
        return [(r[0] if r else None, r[1] if r else "allow") for _, r in ruled]
    n = [Counter(), Counter()]
    for u, good in train:
        for i in range(len(u)):
            for k in range(U.ORDER + 1):
                if i >= k:
                    n[good][u[i - k : i + 1]] += 1
    kept = {g for g in n[0] | n[1] if n[0][g] + n[1][g] >= U.LEAST}
    totals = [Counter(), Counter()]
    for g in n[0] | n[1]:
        for c in (0, 1):
            totals[c][len(g), g[:-1]] += n[c][g]

    def p(c, g):
        if g not in kept:
            return 1 / U.ALPHABET
        low = p(c, g[1:]) if len(g) > 1 else 1 / U.ALPHABET
        return (n[c][g] + U.SMOOTHING * low) / (totals[c][len(g), g[:-1]] + U.SMOOTHING)

    def score(u):
        total = 0.0
        for i in range(len(u)):
            for k in range(U.ORDER, -1, -1):
                if i >= k and u[i - k : i + 1] in kept:
                    g = u[i - k : i + 1]
                    total += math.log(p(1, g) / p(0, g))
                    break
        return total / len(u) if u else 0.0

    scored = [(score(u), g) for u, g in check]
    steps = [(math.floor(min(max(s, -2), 2) * (U.STEPS / 4)), g) for s, g in scored]
    good, bad = sum(g for _, g in steps), sum(not g for _, g in steps)
    t = 0.0
    if good and bad:
        value = {k: round(sum(g for s, g in steps if s >= k) / good + sum(not g for s, g in steps if s < k) / bad, 12) for k in range(-U.STEPS // 2, U.STEPS // 2 + 2)}
        best = [k for k in sorted(value) if value[k] == max(value.values())]
        t = best[len(best) // 2] * 4 / U.STEPS
    return [(r[0] if r else None, r[1] if r else ("allow" if score(u) >= t else "block")) for u, r in ruled]


def test_query_against_brute_force(spark):
    d = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{d}/pages.parquet").collect()
    got = {r.page_id: r for r in U.op4_url_filter(spark, d).collect()}
    assert len(got) == len(pages)
    for p, (rule, verdict) in zip(pages, brute([p.url for p in pages]), strict=True):
        r = got[p.page_id]
        assert (r.host, r.path, r.rule, r.verdict) == (*parts(p.url), rule, verdict), p.url
    assert len({r.verdict for r in got.values() if r.rule is None}) == 2


def test_sql(spark):
    for sf in ("sf0.001", "sf0.01"):
        d = f"/root/testdata/{sf}"
        con = duckdb.connect()
        con.sql(f"CREATE VIEW pages AS SELECT * FROM '{d}/pages.parquet'")
        names = "page_id, host, path, rule, verdict"
        want = sorted(map(str, con.sql(f"SELECT {names} FROM ({U.OP4_SQL})").fetchall()))
        assert sorted(str(tuple(r)) for r in U.op4_url_filter(spark, d).selectExpr(*names.split(", ")).collect()) == want


def test_odd_urls(spark):
    urls = [None, "", "nothing", "http://", "HTTP://WWW.Example.NET/en/x?y#z", "http://net", "http://net/", "http://anet/", "a://b://org/fr/", "http://é.org/fr/\nx", "http://x.org/fr", "http://example.com?/de/"]
    rows = [(None if i % 3 == 0 else i, u, "h") for i, u in enumerate(urls)] * 2
    docs = spark.createDataFrame(rows, "page_id long, url string, host string")
    out = U.judge(docs, "page_id", "url").collect()
    assert len(out) == len(rows)
    assert sorted((str(r.page_id), r.host, r.path, str(r.rule)) for r in out) == sorted((str(i), *parts(u), str((rule_of(*parts(u)) or [None])[0])) for i, u, _ in rows)
    assert all(r.verdict in ("allow", "block") for r in out)
    none = U.judge(docs.where("url is null"), "page_id", "url").collect()
    assert {r.verdict for r in none} == {"allow"}
    assert U.judge(docs.limit(0), "page_id", "url").collect() == []


def test_gram_tables_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(U, "MOST_GRAMS", 3)
    counts = spark.createDataFrame([("a", 50, 0), ("b", 20, 3), ("c", 4, 0), ("d", 4, 0), ("ab", 9, 9)], "g string, a long, r long")
    least = U._least_counts(counts)
    kept = [r.g for r in counts.collect() if r.a + r.r >= least[len(r.g)]]
    assert kept == ["a", "b", "ab"]


def test_no_gram_is_dropped_beyond_the_broadcast(spark, monkeypatch):
    rng = random.Random(3)
    hosts = ["a.net", "b.example.net", "c.example.com", "d.org", "e.info", "f.info"]
    urls = [f"https://{rng.choice(hosts)}/{rng.choice(['en', 'de', 'fr'])}/{''.join(rng.choices('abcdé%019', k=rng.randint(0, 9)))}" for _ in range(1500)] + [""]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    whole = {r.page_id: r for r in U.judge(pages, "page_id", "url").collect()}
    monkeypatch.setattr(U, "MOST_GRAMS", 20)
    cut = {r.page_id: r for r in U.judge(pages, "page_id", "url").collect()}
    assert len(cut) == len(urls)
    for i, (rule, verdict) in enumerate(brute(urls)):
        assert (cut[i].rule, cut[i].verdict) == (whole[i].rule, whole[i].verdict) == (rule, verdict)
        assert math.isclose(cut[i].score, whole[i].score, abs_tol=1e-9)
