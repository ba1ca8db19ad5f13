"""Near-duplicates, lines and components against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellwright.llm import common, embedding_dedup, line_dedup, minhash, tokens

from ..conftest import DATA

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, size=5):
    w = WORD.findall(low(text))
    n = min(size, len(w))
    return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if w else Counter()


def classes(nodes, links):
    top = {n: n for n in nodes}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = classes({x for e in edges for x in e}, edges)
    assert got == {n: c for n, c in want.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def joins(df):
    return re.findall(r"(\w+Join) ", df._jdf.queryExecution().sparkPlan().toString())


def test_components_of_many_edges_are_the_same(spark, monkeypatch):
    edges = spark.createDataFrame([(i, i + k) for i in range(0, 300, 10) for k in (1, 2, 3)], "a long, b long")
    few = sorted(common.components(edges).collect())
    met = []
    monkeypatch.setattr(common, "shuffled", lambda df, f=common.shuffled: met.append(1) or f(df))
    assert sorted(common.components(edges).collect()) == few and not met
    monkeypatch.setattr(common, "BROADCAST_ROWS", 100)
    assert sorted(common.components(edges).collect()) == few and met


def test_a_table_beyond_the_count_is_not_broadcast(spark):
    big, df = spark.range(1000), spark.range(50)
    assert joins(big.join(common.small(df, 50), "id")) == ["BroadcastHashJoin"]
    assert joins(big.join(common.small(df, 49), "id")) == ["SortMergeJoin"]


def test_hashes_of_words_do_not_cross_texts(spark):
    import pyarrow as pa

    texts = ["ab cd", "", "ab", None, "éa-1b cd"]
    found = list(minhash._text_words(pa.array(texts)))
    assert [len(w) for w in found] == [2, 0, 1, 0, 3]
    assert found[0][0] == found[2][0] == np.uint64(tokens.hash_of(b"ab")) and found[0][1] == found[4][2]


def test_signatures_agree_as_often_as_the_similarity():
    rng = np.random.default_rng(3)
    both = rng.integers(0, 2**63, 300).astype(np.uint64)
    a, wa = np.sort(both[:200]), np.ones(200)
    b, wb = np.sort(both[100:]), np.ones(200)
    wa[:50], wb[:50] = 3.0, 0.5
    sets = np.repeat([0, 1], 200)
    x, y = minhash.signatures_of(sets, np.concatenate([a, b]), np.concatenate([wa, wb]), 2, 4000)
    assert (minhash.signatures_of(sets[:200], a, wa, 1, 4000)[0] == x).all()
    assert abs((x == y).mean() - minhash.similarity(a, wa, b, wb)) < 0.035


def test_near_duplicates_are_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = {r.doc_id: shingles(r.text) for r in docs.collect()}
    links = []
    ids = sorted(rows)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = rows[a], rows[b]
            both = sum((x & y).values())
            if x and y and both / (sum(x.values()) + sum(y.values()) - both) >= 0.8:
                links.append((a, b))
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    assert got == classes(ids, links) and links


def test_near_duplicates_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [(1, None), (2, ""), (3, "..."), (4, "one two"), (5, "one two"), (5, "one two"), (6, long), (7, long.replace("w7 ", "q ")), (None, long), (8, "...")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"band": F.lit(1), "node": F.lit(2), "digest": F.lit("x")})
    got = sorted(((r.doc_id, r.class_id, r.kept) for r in minhash.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 1, True), (2, 2, True), (3, 3, True), (8, 8, True), (4, 4, True), (5, 4, False), (5, 4, False), (6, 6, True), (7, 6, False), (None, None, True)], key=str)
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == 7
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_different_texts_of_one_id_are_apart(spark):
    base = " ".join(f"w{i}" for i in range(200))
    other = " ".join(f"v{i}" for i in range(200))
    docs = spark.createDataFrame([(1, base), (2, base.replace("w7 ", "q ")), (2, other), (3, other.replace("v9 ", "q "))], "doc_id long, text string")
    got = sorted((r.doc_id, r.class_id, r.kept) for r in minhash.near_duplicates(docs).collect())
    assert got == [(1, 1, True), (2, 1, False), (2, 2, True), (3, 2, False)]
    assert sorted((r.doc_id, r.text) for r in minhash.drop_near_duplicates(docs).collect()) == [(1, base), (2, other)]


def test_a_large_group_of_near_copies_is_one_class(spark):
    rng = random.Random(2)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        text = list(base)
        text[rng.randrange(120)] = f"x{i}"
        rows.append((i, " ".join(text)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.class_id for r in got.collect()} == {0}


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@pytest.fixture(scope="module")
def some_lines():
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abé😀") for _ in range(n))
    base = [word(rng.randint(4, 36)) for _ in range(25)]
    out = set(base)
    for _ in range(150):
        s = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            p = rng.randrange(len(s) + 1)
            s[p : p + rng.choice([0, 1, 1])] = rng.choice([[], ["a"], ["é"]])
        out.add("".join(s))
    return sorted(out - {""})


@pytest.mark.parametrize(("edits", "hot"), [(1, 24), (2, 24), (2, 0), (3, 24)])
def test_edit_join_finds_every_pair(spark, some_lines, edits, hot, monkeypatch):
    plain = line_dedup.candidates
    monkeypatch.setattr(line_dedup, "candidates", lambda lines, e: plain(lines, e, hot))
    df = spark.createDataFrame([(i, s, len(s)) for i, s in enumerate(some_lines)], "id long, line string, size int")
    got = sorted((r.a, r.b) for r in line_dedup.edit_links(df, edits).collect())
    n = len(some_lines)
    want = [(i, j) for i in range(n) for j in range(i + 1, n) if min(len(some_lines[i]), len(some_lines[j])) > edits and edit(some_lines[i], some_lines[j]) <= edits]
    assert got == want and want


def test_line_joins_are_not_broadcast_by_the_size_of_files(spark):
    # a crowd: 90 lines share a beginning and an end, so that finer keys, 28 of each line, are joined
    rng = random.Random(4)
    lines = [f"the same beginning {''.join(rng.choices('abcdefgh', k=12))} and the same end" for _ in range(90)]
    rows = [(i, s, len(s)) for i, s in enumerate([*lines, lines[0] + "!"])]
    df = line_dedup.written(spark.createDataFrame(rows, "id long, line string, size int"), "test")
    assert joins(line_dedup.candidates(df, 2)) == ["SortMergeJoin"]
    links = line_dedup.edit_links(df, 2)
    assert set(joins(links)) == {"SortMergeJoin"} and (0, 90) in {tuple(r) for r in links.collect()}
    docs = df.select(F.col("id").alias("doc_id"), F.col("line").alias("text"))
    assert joins(line_dedup.line_classes(docs)) == ["SortMergeJoin"]


def test_lines_of_documents(spark):
    a, b, c = "the first line of all the lines", "the first line of all the lined", "something else that is long enough"
    rows = [(1, f"{a}\n{c}"), (2, f"{b}\nshort\n{a}"), (3, f" {a} \n{b}"), (4, None), (5, ""), (6, f"{c}\n{c}\nnew and long enough line here"), (None, a), (3, f" {a} \n{b}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n_chars": F.lit(0).cast("long"), "line": F.lit(1), "component": F.lit(1), "key": F.lit(3)})
    got = {(r.doc_id, r.line_no): (r.class_doc, r.class_line, r.n_links, r.kept) for r in line_dedup.line_classes(docs).collect()}
    assert got[1, 0] == (1, 0, 1, True) and got[2, 0] == (1, 0, 1, False) and got[2, 1] == (2, 1, 0, True) and got[6, 1] == (1, 1, 0, False)
    left = sorted(((r.doc_id, r.text) for r in line_dedup.drop_repeated_lines(docs).collect()), key=str)
    assert left == sorted([(1, f"{a}\n{c}"), (2, "short"), (4, None), (5, ""), (6, "new and long enough line here")], key=str)
    assert line_dedup.drop_repeated_lines(docs).columns == docs.columns
    assert line_dedup.drop_repeated_lines(docs.limit(0)).count() == 0
    nobody = docs.where("doc_id is null")
    assert [r.text for r in line_dedup.drop_repeated_lines(nobody).collect()] == [a]


def test_short_lines_are_classes_too(spark):
    lines = ["x", "x", "yes", "yes!", "yes", "", "", "twelve chars", "twelve char", "twelve chair", "elve chars", "nine char", "nine chars", "a line of nineteen.", "a line of nineteen.!", "a line of ninetee!", "a line of nineteen.!!"]
    docs = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "doc_id long, text string")
    allowed = lambda s: min(2, len(s) // 10)
    links = [
        (i, j) for i, a in enumerate(lines) for j, b in enumerate(lines)
        if i < j and a and b and edit(a, b) <= min(allowed(a), allowed(b))
    ]
    got = {r.doc_id: (r.class_doc, r.kept, r.n_links) for r in line_dedup.line_classes(docs).collect()}
    top = classes(range(len(lines)), links)
    near = {i: len({lines[k] for e in links if i in e for k in e} - {lines[i]}) for i in top}
    assert got == {i: (c, c == i, near[i]) for i, c in top.items()}
    assert got[1] == (0, False, 0) and got[4] == (2, False, 0) and got[6][1] and got[9][0] == 7
    assert sorted(r.doc_id for r in line_dedup.drop_repeated_lines(docs).collect()) == [i for i, c in top.items() if c == i]


def test_embeddings_are_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(30, 16))
    rows = []
    for i in range(240):
        v = base[i % 30] + rng.normal(size=16) * rng.choice([0.05, 0.12, 0.3])
        rows.append((i, v.tolist(), int(i % 3) if i % 50 else None))
    rows += [(300, rows[1][1], rows[1][2]), (301, None, 1), (302, [0.0] * 16, 1), (303, [float("nan")] * 16, 1), (304, [None] * 16, 1), (305, [1.0, 2.0], 1), (306, [2.0, 4.0], 1), (None, rows[1][1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({"node": F.lit(1), "unit": F.lit(2)})
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df, block=64).collect()}

    def unit(v):
        if v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        return np.array(v) / np.linalg.norm(v)

    good = [(i, unit(v), k) for i, v, k in rows if i is not None]
    links = [(a, b) for x, (a, u, p) in enumerate(good) for b, w, q in good[x + 1 :] if u is not None and w is not None and p == q and p is not None and len(u) == len(w) and u @ w >= 0.93]
    top = classes([i for i, *_ in good], links)
    n = Counter(x for e in links for x in e)
    assert links and got.pop(None) == (0, None, True)
    assert got == {i: (n[i], top[i], top[i] == i) for i, *_ in good}
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_embeddings_that_links_reach_within_a_group():
    u, v = np.array([5, 1, 7, 3, 8]), np.array([4, 5, 3, 9, 8])
    assert embedding_dedup.reached(u, v, 10).tolist() == [0, 1, 2, 3, 1, 1, 6, 3, 8, 3]
    path = np.arange(999)
    assert not embedding_dedup.reached(path, path + 1, 1000).any()
    none = np.zeros(0, np.int64)
    assert embedding_dedup.reached(none, none, 3).tolist() == [0, 1, 2]
