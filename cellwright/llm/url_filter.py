"""URL filter: host rules first, then naive Bayes over segmented host and path words.

Names in hosts are often words written together. A unigram Viterbi search splits each distinct name
by the counts of words in given texts; the counts are joined to the substrings of the names, so the
dictionary may have any size. A multinomial naive Bayes classifier then scores the words of host and
path; its counts are a table of words, joined to those of each distinct url. It is fitted on all
urls, those with a seed word in the host standing for the blocked class.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, written

#: Longest word of the dictionary, which is the longest name a host may have.
MAX_WORD = 63

# Fixed word list: host words that mark a url for the blocked class.
SEEDS = """ads adserver advert banner track tracker tracking popup spam malware phishing warez torrent crack keygen
casino poker bet bets betting gamble lottery jackpot slots pills pharma viagra cialis replica
porn porno xxx sex adult nude escort webcam""".split()
_CLASS = {"block": 1, "allow": 0}


def split_url(url: str) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a url; both empty if it is null or has no "://"."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule (host, path, verdict) that fits, else nulls. A rule fits its
    host and all subdomains if the path starts with the rule's; of rules of equal length the first in
    order of their text."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    by_text = sorted(rules, key=lambda r: r[0] + r[1], reverse=True)
    for h, p, v in sorted(by_text, key=lambda r: len(r[0] + r[1])):  # later ones win
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _names(column: Column) -> Column:
    return F.filter(F.split(F.lower(column), r"[^\p{L}]+"), lambda x: x != "")


def viterbi(name: str, arcs: list[tuple[int, int, float]], total: float) -> list[str]:
    """The likeliest split of name into words: arcs (start, length, count) are dictionary words, any
    other run of letters costs as a word that was never seen, more for each letter."""
    n = len(name)
    at: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for start, length, count in arcs:
        if start < n:
            at[start].append((length, math.log(total / count)))
    # score and last step of the best split up to each place; an unseen run may go on
    best, back = [math.inf] * (n + 1), [(0, False)] * (n + 1)
    run, since = [math.inf] * (n + 1), [0] * (n + 1)
    best[0] = 0.0
    letter = math.log(10.0)
    for i in range(n):
        if best[i] < math.inf:
            for length, cost in at[i]:
                if i + length <= n and best[i] + cost < best[i + length]:
                    best[i + length], back[i + length] = best[i] + cost, (i, True)
        fresh, longer = best[i] + math.log(total + 1.0) + letter, run[i] + letter
        run[i + 1], since[i + 1] = (fresh, i) if fresh <= longer else (longer, since[i])
        if run[i + 1] < best[i + 1]:
            best[i + 1], back[i + 1] = run[i + 1], (since[i + 1], False)
    out, i = [], n
    while i:
        start = back[i][0]
        out.append(name[start:i])
        i = start
    return out[::-1]


def dictionary(texts: DataFrame, hosts: DataFrame) -> DataFrame:
    """(word, c): how often words of up to MAX_WORD letters occur in the column text of texts and in
    names with hyphens in the column host of hosts; seed words count once at least."""
    parts = texts.select(F.explode_outer(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word"))
    hyphened = hosts.select(F.explode_outer(F.split("host", r"\.")).alias("part")).where("part like '%-%'")
    parts = parts.union(hyphened.select(F.explode_outer(_names(F.col("part"))).alias("word")))
    seeds = hosts.sparkSession.createDataFrame([(w,) for w in SEEDS], "word string")
    fits = (F.length("word") > 0) & (F.length("word") <= MAX_WORD)
    return parts.union(seeds).where(fits).groupBy("word").agg(F.count("*").alias("c"))


def segment(names: DataFrame, words: DataFrame) -> DataFrame:
    """(name, words): the distinct names, each split into words by the dictionary (word, c)."""
    total = float(words.agg(F.sum("c")).first()[0] or 1)
    names = names.where("name <> ''").distinct()
    starts = names.select("name", F.explode(F.sequence(F.lit(1), F.length("name"))).alias("i"))
    subs = starts.select("name", "i", F.explode(F.sequence(F.lit(1), F.least(F.lit(MAX_WORD), F.length("name") - F.col("i") + 1))).alias("n"))
    subs = subs.select("name", "i", "n", F.expr("substring(name, i, n)").alias("word"))
    arcs = subs.join(words, "word").groupBy("name").agg(F.collect_list(F.struct("i", "n", F.col("c").cast("double").alias("c"))).alias("arcs"))

    @F.pandas_udf("array<string>")
    def split(name: pd.Series, arcs: pd.Series) -> pd.Series:
        return pd.Series([viterbi(x, [(a["i"] - 1, a["n"], a["c"]) for a in (y if y is not None else [])], total) for x, y in zip(name, arcs, strict=True)])

    return names.join(arcs, "name", "left").select("name", split("name", "arcs").alias("words"))


def judge(pages: DataFrame, texts: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(page_id, host, path, rule, verdict, words, log_odds) for every row of pages (page_id, url).

    verdict is that of the longest fitting rule, else "block" where the classifier finds the blocked
    class likelier and "allow" otherwise; log_odds are its log-odds for blocking. A null url, or one
    without "://", has an empty host and path and is allowed, as is every url without words. Rows may
    repeat; other columns are ignored. texts (text) teach the words; nulls there are skipped. If no
    host has a seed word, no url is blocked but by rules."""
    host, path = split_url("url")
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    hosts = written(urls.groupBy("host").count().select("host"), "hosts")
    words = written(dictionary(texts, hosts), "words")
    parts = hosts.select("host", F.posexplode(_names(F.col("host"))).alias("i", "name"))
    cut = written(segment(parts.select("name"), words), "names")
    named = parts.join(cut, "name").groupBy("host").agg(F.array_sort(F.collect_list(F.struct("i", "words"))).alias("p"))
    named = written(named.select("host", F.flatten("p.words").alias("host_words")), "segmented")
    once = urls.groupBy("host", "path").agg(F.count("*").alias("n")).join(small(named, 100_000), "host", "left")
    host_words = F.coalesce("host_words", F.array().cast("array<string>"))
    seeded = F.arrays_overlap(host_words, F.array(*[F.lit(w) for w in SEEDS])).cast("long")
    once = once.select("host", "path", "n", seeded.alias("seeded"), F.concat(host_words, _names(F.col("path"))).alias("words"))
    once = written(once.withColumn("place", F.monotonically_increasing_id()), "urls")
    odds, prior = word_odds(once)
    sums = once.select("place", F.explode("words").alias("word")).join(small(odds), "word").groupBy("place").agg(F.sum("odds").alias("odds"))
    scored = once.join(sums, "place", "left").select("host", "path", "words", (F.lit(prior) + F.coalesce("odds", F.lit(0.0))).alias("log_odds"))

    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = F.when((F.col("log_odds") > 0) & (F.size("words") > 0), "block").otherwise("allow")
    return urls.join(scored, ["host", "path"]).select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, judged).alias("verdict"), "words", "log_odds")


def word_odds(urls: DataFrame) -> tuple[DataFrame, float]:
    """(word, odds) of urls (n, seeded, words), each occurring n times and of the blocked class if seeded
    is 1: the log of a word's share in blocked urls over its share in others, one being added to each
    count; and the log-odds of the classes. Without a blocked url the latter are minus infinity."""
    bad = F.col("seeded") * F.col("n")
    counts = urls.select("n", "seeded", F.explode("words").alias("word")).groupBy("word").agg(F.sum(bad).alias("block"), F.sum(F.col("n") - bad).alias("allow"))
    counts = written(counts, "counts")
    known = counts.agg(F.count("*").alias("words"), F.sum("block").alias("block"), F.sum("allow").alias("allow")).first()
    share = [(F.col(c) + 1.0) / float(known[c] + known["words"] if known["words"] else 1) for c in ("block", "allow")]
    of = urls.agg(F.sum(bad).alias("block"), F.sum("n").alias("all")).first()
    prior = math.log(of["block"] / max(of["all"] - of["block"], 1)) if of["block"] else -math.inf
    return counts.select("word", F.log(share[0] / share[1]).alias("odds")), prior
