"""Decontamination, language models, language, toxicity, mixing."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellwright.llm import decontamination, language_id, language_model, line_dedup, mixing, queries, tokens, toxicity

from ..conftest import DATA
from .test_dedup import WORD, low


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({"key": F.lit(1), "w": F.lit("x"), "hash": F.lit(2), "token": F.lit(3)})


def contamination(docs, items, width=10):
    grams = {}
    for i, text in items:
        w = WORD.findall(low(text))
        n = min(width, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            grams.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = {}
    for i, text in docs:
        w, hit, found = WORD.findall(low(text)), set(), set()
        for n in {len(g) for g in grams}:
            for k in range(len(w) - n + 1):
                if (g := tuple(w[k : k + n])) in grams:
                    hit |= set(range(k, k + n))
                    found |= grams[g]
        out[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit))
    return out


def test_contamination_whole_tables(spark):
    docs, bench = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {r[0]: tuple(r)[1:] for r in queries.op4_decontamination(spark, DATA).collect()}
    want = contamination([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    assert got == want and any(w[4] for w in want.values())


def test_contamination_edge_cases(spark):
    w = [f"w{i}" for i in range(30)]
    items = [(1, " ".join(w[:12])), (2, "Short Item"), (3, None), (4, "--"), (5, " ".join(w[:12])), (6, "one")]
    rows = [(1, " ".join(w)), (2, "a short ITEM! short item"), (3, None), (4, ""), (5, "," + ", ".join(w[1:11]) + "."), (6, "ONE"), (7, "short"), (8, " ".join(["one"] * 5000)), (None, " ".join(w[:12]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of(spark, rows)
    got = {r[0]: tuple(r)[1:] for r in decontamination.contamination(docs, bench).collect()}
    assert got == contamination(rows, items)
    assert sorted(r.doc_id for r in decontamination.decontaminate(docs, bench).collect()) == [3, 4, 7]
    cut = {r.doc_id: r.text for r in decontamination.decontaminate(docs, bench, remove="spans").collect()}
    assert cut[2] == "a" and cut[1] == " ".join(w[12:]) and cut[3] is None and cut[7] == "short" and cut[8] == ""
    assert decontamination.decontaminate(docs, bench).columns == docs.columns
    none = decontamination.contamination(docs, bench.limit(0)).collect()
    assert len(none) == len(rows) and not any(r.contaminated for r in none)
    assert decontamination.contamination(docs.limit(0), bench).count() == 0


def test_large_sets_of_windows_are_joined_by_a_shuffle(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "benchmark"))
    want = sorted(map(tuple, decontamination.contamination(docs, bench).collect()))
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, decontamination.contamination(docs, bench).collect())) == want


def test_helper_names_do_not_clash(spark):
    rows = [(1, "one two three\nfour"), (2, "one two three\nfive"), (None, "six"), (None, "seven eight")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("_gone", "_text", "_cut", "_rate", "gone", "left", "of", "key", "cut_of", "key_of", "doc_of", "Rate_of_doc", "mark")})
    bench = spark.createDataFrame([(1, "two three four")], "item_id long, text string")
    assert {r.text for r in decontamination.decontaminate(docs, bench, remove="spans").collect()} == {"one", rows[1][1], "six", "seven eight"}
    mixed = mixing.mix(docs, docs.select("text", F.lit("x").alias("domain")))
    assert mixed.count() == 4 and mixed.columns == [*docs.columns, "rate"]
    assert sorted(r.n_tokens for r in mixing.mixing_rates(docs, docs.select("text", F.lit("x").alias("domain"))).where("doc_id is null").collect()) == [1, 2]
    assert sorted(r.text for r in line_dedup.drop_repeated_lines(docs).collect()) == ["five", "one two three\nfour", "seven eight", "six"]


SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def test_language_model_whole_table(spark):
    docs = {r.doc_id: SPACE.findall(low(r.text)) + [" "] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    c = Counter(w for i, ws in docs.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    rows = queries.op7_language_model(spark, DATA).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ws = docs[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(ws), sum(c[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws))
    assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out)


def plain_model(texts):
    """Counts of n-grams, and the probability of a word after a history of up to two, by recursion."""
    runs = [[" ", *SPACE.findall(low(t)), " "] for t in texts]
    c1 = Counter(w for r in runs for w in r[1:])
    grams = [Counter(tuple(r[i : i + k]) for r in runs for i in range(len(r) - k + 1)) for k in (2, 3)]
    grams = {g: c for level in grams for g, c in level.items() if c >= 2}
    n, v = sum(c1.values()), len(c1)
    one, two = (sum(c == k for c in c1.values()) for k in (1, 2))
    off = min(0.9, max(0.1, one / (one + 2 * two))) if one + two else 0.5

    def p(w, h):
        if not h:
            return (c1[w] - off) / n if c1[w] else off * v / n
        own = [c for g, c in grams.items() if g[:-1] == h]
        all_of = c1[h[0]] if len(h) == 1 else grams.get(h, 0)
        left = 1 - sum(c - off for c in own) / all_of if own else 1.0
        return (max(grams[h + (w,)] - off, 0) / all_of if h + (w,) in grams else 0.0) + left * p(w, h[1:])

    return c1, p


def plain_score(p, text):
    words, out = [" ", *SPACE.findall(low(text)), " "], 0.0
    for i in range(1, len(words)):
        out += math.log10(p(words[i], tuple(words[max(0, i - 2) : i])))
    return out


def test_plain_model_is_normalised():
    c1, p = plain_model(["a b a b c a b", "b c a a b", "a b c d", "", ""])
    for h in [(), ("a",), ("b",), (" ",), ("a", "b"), ("d", "c"), (" ", "a")]:
        assert sum(p(w, h) for w in [*c1, "never"]) == pytest.approx(1)


def test_lanes_read_like_a_walk():
    rng = np.random.default_rng(0)
    words = (np.array([30.0, 20, 10, 9]), np.array([20.0, 10, 0, 5]), np.array([2.0, 2, 0, 1]))
    pairs = (np.array([12.0, 8, 6, 4, 5]), np.array([7.0, 0, 0, 2, 0]), np.array([2.0, 0, 0, 1, 0]), np.array([0, 0, 1, 1, 3]), np.array([0, 1, 0, 2, 1]))
    runs = (np.array([4.0, 3, 2]), np.array([0, 0, 3]), np.array([0, 1, 0]), np.array([0, 1, 0]))
    m = language_model.automaton(3, words, pairs, runs, 69, 4, 0.5)
    run = rng.integers(0, 4, 700)
    run[[0, 301]] = -2
    state, out = np.zeros(1, np.int64), []
    for w in run:
        state, q = m.step(state, np.array([w]))
        out.append(q[0])
    assert np.allclose(m.read(run), out)


def test_language_model_is_plain_recursion(spark):
    rare = "quite unusual phrase here"
    rows = [(1, rare), (2, rare), *[(i, " ".join(f"w{(i * 7 + k * k) % 37}" for k in range(120))) for i in range(3, 20)], (50, f"{rare} w1 new"), (51, "phrase unusual w3 w3"), (52, ""), (53, rare.upper())]
    docs = docs_of(spark, rows)
    _, p = plain_model([t for i, t in rows if i < 50])
    want = {i: plain_score(p, t) for i, t in rows}
    for size in (1 << 20, 300):  # all in few chunks, and each text in one of its own
        got = {r.doc_id: r.score for r in language_model.fit_and_score(docs, F.col("doc_id") < 50, chunk=size).collect()}
        assert got == pytest.approx(want, rel=1e-9)


def test_language_model_edge_cases(spark):
    docs = docs_of(spark, [(1, None), (2, ""), (3, "A a"), (3, "A a"), (None, "a b"), (4, "x" * 5000)])
    rows = language_model.fit_and_score(docs, F.coalesce(F.col("doc_id") < 4, F.lit(True))).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.n_known) for r in rows) == [(0, 3, 3), (1, 1, 1), (2, 1, 1), (3, 3, 3), (3, 3, 3), (4, 2, 1)]
    nothing = language_model.fit_and_score(docs, F.lit(False)).collect()
    assert {(r.train_tokens, r.score, r.base_score) for r in nothing} == {(0, 0.0, 0.0)}
    assert language_model.fit_and_score(docs.limit(0), F.lit(True)).count() == 0


def test_missed_mixing_targets_are_reported(spark):
    soft = spark.createDataFrame([(100, 0.9, 0.1), (50, 0.4, 0.6), (10, 0.2, 0.8)], "n_tokens long, p0 double, p1 double")
    with pytest.warns(RuntimeWarning, match="missed after 1 steps"):
        assert len(mixing.fit_rates(soft, [0.0, 160.0], max_steps=1)) == 1


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = queries.op6_language_id(spark, DATA).join(docs, "doc_id").where("held_out and lang is not null").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.85 and all(0 <= r.score <= 1 for r in rows)


def test_language_edge_cases(spark):
    rows = [(i, "the cat and the dog are in the house", "en") for i in range(30)] + [(i + 30, "der hund und die katze sind im haus", "de") for i in range(30)]
    docs = spark.createDataFrame([*rows, (90, None, "en"), (91, "", "de"), (92, "12 !", "en"), (93, "und die katze " * 3000, None), (None, "the dog", None)], "doc_id long, text string, lang string")
    net = language_id.fit(docs, F.lit(True))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(docs, net).collect()}
    assert got[90] == got[91] == got[92] == ("und", 0.0) and got[93][0] == "de" and got[0][0] == "en" and got[None][0] == "en"
    assert language_id.fit(docs, F.lit(False)) is None
    assert {r.lang_pred for r in language_id.predict(docs, None).collect()} == {"und"}
    assert language_id.predict(docs.limit(0), net).count() == 0


def test_toxicity_features_and_model(spark):
    import pyarrow as pa

    x = toxicity.features(pa.array(["You idiot!!", None, "", "A 1d10t, he is", "nothing here"]), np.zeros(0, np.uint64))
    f = {n: x[:, k] for k, n in enumerate(toxicity.FEATURES)}
    assert f["insult"][0] == 0.5 and f["near_share"][0] == 1.0 and f["repeated_sign"][0] > 0
    assert not x[1].any() and not x[2].any() and f["obfuscated"][3] > 0 and f["insult"][3] == 0
    rows = [(i, "you are such an idiot you fool" if i % 4 == 0 else "a calm text about the weather today number", int(i % 4 == 0)) for i in range(200)]
    docs = spark.createDataFrame([(i, f"{t} w{i}") for i, t, _ in rows] + [(900, None), (901, ""), (None, "you idiot")], "doc_id long, text string").withColumn("label", F.lit(1))
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None), (5, 7)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all((got[i] >= 0.5) == bool(y) for i, _, y in rows) and got[900] == got[901] < 0.5 <= got[None]
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == 152
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_isotonic_is_monotone_and_least_squares():
    x, y = isotonic = toxicity.isotonic(np.array([1.0, 2, 3, 4, 4, 5]), np.array([0.0, 1, 0, 1, 0, 1]))
    assert len(isotonic) == 2 and (np.diff(x) > 0).all() and (np.diff(y) >= 0).all() and y[0] == 0 and y[-1] == 1


def test_mixing_meets_targets(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labelled = docs.select("text", F.col("lang").alias("domain"))
    model = mixing.train(labelled)
    soft = mixing.posteriors(docs, model)
    k = len(model[1])
    total = soft.agg(F.sum("n_tokens")).first()[0]
    steps = mixing.fit_rates(soft, [total / k] * k)
    rows = soft.withColumn("rate", mixing.rate_of(steps, k)).collect()
    p = np.array([[r[f"p{i}"] for i in range(k)] for r in rows])
    n, rate = np.array([r.n_tokens for r in rows], float), np.array([r.rate for r in rows])
    assert (rate >= 0).all() and np.allclose((n * rate) @ p, total / k, rtol=1e-4)
    # a plain projected gradient on the same problem ends at the same rates
    u, a = np.sqrt(n), np.sqrt(n)[:, None] * p
    inverse = np.linalg.pinv(a.T @ a)
    for _ in range(60):
        u = np.maximum(0, u - a @ (inverse @ (a.T @ u - total / k)))
    assert np.allclose(u / np.sqrt(np.maximum(n, 1e-9)), rate, atol=1e-3)
    best = {r.doc_id: r.domain for r in mixing.mixing_rates(docs, labelled).collect()}
    known = [(r.doc_id, r.lang) for r in docs.collect() if r.lang]
    assert np.mean([best[i] == lang for i, lang in known]) > 0.9


def test_mixing_edge_cases(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (3, ""), (4, "x y z " * 4000), (4, "x"), (None, "a b")], "doc_id long, text string").withColumns({"rate": F.lit(9), "bucket": F.lit(1)})
    labelled = spark.createDataFrame([("a b c", "one"), ("x y z", "two"), ("q", None), (None, "one")], "text string, domain string")
    got = {r.doc_id: r for r in mixing.mixing_rates(docs, labelled, {"one": 3.0, "two": 1.0}).collect()}
    assert len(got) == 5 and got[2].rate == got[3].rate == 1.0 and got[2].domain is None and got[1].domain == "one" and got[4].domain == "two"
    assert got[1].rate > 1 > got[4].rate >= 0
    out = mixing.mix(docs, labelled)
    assert sorted(out.columns) == sorted(docs.columns) and out.count() == docs.count()
    assert {r.rate for r in mixing.mixing_rates(docs, labelled.limit(0)).collect()} == {1.0}
    assert mixing.mixing_rates(docs.limit(0), labelled).count() == 0


def test_mixing_takes_any_number_of_domains(spark):
    n = 70
    rows = [(k, " ".join([f"word{k}", f"term{k}"] * 6), f"d{k:02}") for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, domain string")
    got = mixing.mixing_rates(docs, docs.select("text", "domain")).collect()
    words = docs.select(F.explode(F.split("text", " ")).alias("w")).distinct()
    shared = Counter(r.b for r in words.select(mixing._bucket("w").alias("b")).collect())
    assert len(got) == n and sum(r.domain == f"d{r.doc_id:02}" for r in got) >= n - 2 * sum(c - 1 for c in shared.values())
    assert all(r.rate >= 0 and r.n_tokens == 12 for r in got)


def test_mix_takes_the_place_of_a_rate_in_any_case(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b", 5, 6), (2, "c", 7, 8)], "doc_id long, text string, Rate int, rAte2 int")
    mixed = mixing.mix(docs, docs.select("text", F.lit("x").alias("domain")))
    assert mixed.columns == ["doc_id", "text", "rAte2", "rate"]
    mixed.write.parquet(str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).count() == 2


def test_contamination_gives_each_row(spark):
    leak = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, leak), (1, leak), (1, "clean"), (None, leak), (None, leak), (2, None), (2, None), (3, "")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, leak)], "item_id long, text string")
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in decontamination.contamination(docs, benchmark).collect()), key=str)
    assert got == sorted([(1, 10, 10, True)] * 2 + [(1, 1, 0, False)] + [(None, 10, 10, True)] * 2 + [(2, 0, 0, False)] * 2 + [(3, 0, 0, False)], key=str)
