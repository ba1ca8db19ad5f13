"""URL filter and revisits."""

import random

from pyspark.sql import functions as F

from cellwright.llm import queries, url_filter, warc

from ..conftest import DATA


def plain_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail], default=len(tail))
    return "".join(c.lower() if c.isascii() else c for c in host), tail[:end]


def plain_rule(host, path):
    fits = [(h + p, v) for h, p, v in queries.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[0])) if fits else (None, None)


def test_whole_table(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    rows = queries.op1_url_filter(spark, DATA).collect()
    assert len(rows) == len(urls)
    for r in rows:
        assert (r.host, r.path) == plain_split(urls[r.page_id])
        rule, verdict = plain_rule(r.host, r.path)
        assert r.rule == rule and r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)
        if rule is None and ("cheap-pills" in r.host or "spam-farm" in r.host):
            assert r.verdict == "block"


def test_edge_cases(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.ORG/fr/x", "x://org/fr", "a://b://c/d", "http://É.net?q", "http://sub.example.com/de/1#f", "http://spamfarm.example.org/x", "http://" + "spam" * 500, "http://h\n/p\n?q"]
    pages = spark.createDataFrame([(i % 11, u) for i, u in enumerate(urls)], "page_id long, url string").withColumns({"host": F.lit(1), "words": F.lit(2), "name": F.lit(3)})
    texts = spark.createDataFrame([("spam farm spam farm the",), (None,), ("",)], "text string")
    rows = url_filter.judge(pages, texts, queries.RULES).collect()
    assert len(rows) == len(urls)
    got = {(r.host, r.path): r for r in rows}
    assert set(got) == {plain_split(u) for u in urls}
    assert list(got["spamfarm.example.org", "/x"].words)[:2] == ["spam", "farm"] and got["", ""].verdict == "allow"
    assert url_filter.judge(pages.limit(0), texts, queries.RULES).count() == 0


def test_viterbi_prefers_words_and_keeps_unknown_runs_whole():
    arcs = [(0, 5, 10.0), (5, 5, 10.0), (0, 1, 1.0)]
    assert url_filter.viterbi("cheappills", arcs, 100.0) == ["cheap", "pills"]
    assert url_filter.viterbi("zzcheap", [(2, 5, 10.0)], 100.0) == ["zz", "cheap"]
    assert url_filter.viterbi("zzz", [], 1.0) == ["zzz"]


def test_canonical_urls(spark):
    same = ["http://www.Example.com/a/", "https://example.com:443/a?utm_source=x#top", "https://m.example.com/a.html", "example.com/a?ref=y"]
    df = spark.createDataFrame([(u,) for u in [*same, "http://example.com/a?b=2&a=1", None]], "u string")
    got = [r[0] for r in df.select(warc.canonical(F.col("u"))).collect()]
    assert got[:4] == ["example.com/a"] * 4 and got[4] == "example.com/a?a=1&b=2" and got[5] is None


def test_revisits_against_a_loop(spark):
    rng = random.Random(8)
    rows = []
    for i in range(300):
        kind = rng.choice(["response", "revisit", "revisit", "metadata"])
        url = rng.choice(["http://a.com/x", "http://a.com/y", "http://a.com/z", None])
        rows.append((i, url, rng.choice([None, *range(0, 200_000, 9_000)]), kind, rng.choice([None, '"1"', 'W/"1"', '"2"']), rng.choice([None, 1, 2]), rng.choice([None, "d"]), {"ETag": "e%d" % i, "Content-Type": "t%d" % i}))
    df = spark.createDataFrame(rows, "record_id long, url string, ts long, kind string, etag string, last_modified long, digest string, headers map<string,string>").withColumns({"canonical": F.lit(1), "slice": F.lit(2)})
    want = {}
    for i, url, ts, kind, etag, modified, digest, headers in rows:
        if kind != "revisit":
            continue
        old = [r for r in rows if r[3] == "response" and url is not None and r[1] == url and ts is not None and r[2] is not None and r[2] < ts]
        if not old:
            want[i] = (None, "unmatched", None)
            continue
        ref = max(old, key=lambda r: (r[2], r[0]))
        strong = lambda e: e and e.removeprefix("W/")
        checks = [(strong(etag), strong(ref[4])), (modified, ref[5]), (digest, ref[6])]
        outcome = next(("resolved" if a == b else "mismatch" for a, b in checks if a is not None and b is not None), "unverified")
        merged = {"etag": headers["ETag"], "content-type": ref[7]["Content-Type"]}
        want[i] = (ref[0], outcome, merged if outcome != "mismatch" else None)
    got = {r.record_id: (r.ref_id, r.outcome, r.headers) for r in warc.resolve_revisits(df).collect()}
    assert got == want
    assert warc.resolve_revisits(df.limit(0)).count() == 0


def test_revisits_whole_table_against_sql(spark, duck):
    rows = {r.record_id: (r.canonical, r.ts, r.ref_id, r.outcome, r.headers) for r in queries.op3_revisits(spark, DATA).collect()}
    got = duck.execute(queries.ORACLES["op3_revisits"])
    names = [d[0] for d in got.description]
    want = {}
    for r in got.fetchall():
        x = dict(zip(names, r, strict=True))
        want[x["record_id"]] = (x["canonical"], x["ts"], x["ref_id"], x["outcome"], x["headers"])
    assert rows == want


def test_headers_that_differ_in_case_alone(spark):
    rows = [(1, "http://a.com/x", 1, "response", None, None, "d", {"ETag": "1", "etag": "2", "Date": "x"}), (2, "http://a.com/x", 2, "revisit", None, None, "d", {"date": "y", "DATE": "z"})]
    df = spark.createDataFrame(rows, "record_id long, url string, ts long, kind string, etag string, last_modified long, digest string, headers map<string,string>")
    assert warc.resolve_revisits(df).first().headers == {"etag": "1, 2", "date": "y, z"}


def test_of_equally_long_rules_the_first_wins(spark):
    rules = [("b.com", "/a", "block"), ("a.b.com", "/", "allow"), ("com", "/abc/", "allow"), ("com", "/abcd", "block")]
    df = spark.createDataFrame([("x.com", "/abc/"), ("x.com", "/abcd/"), ("b.com", "/abcd")], "host string, path string")
    rule, verdict = url_filter.rule_of(F.col("host"), F.col("path"), [*rules, ("b.com", "/ab", "allow")])
    assert [tuple(r) for r in df.select(rule, verdict).collect()] == [("com/abc/", "allow"), ("com/abcd", "block"), ("b.com/ab", "allow")]
