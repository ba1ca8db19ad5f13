"""Importance resampling against a plain version, on the whole table and on odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

from cellwright.llm import importance, queries

from ..conftest import DATA
from .test_dedup import low

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text, size=2):
    words = WORD.findall(low(text or ""))
    grams = (" ".join(words[i : i + k]) for i in range(len(words)) for k in range(1, size + 1) if i + k <= len(words))
    return len(words), [zlib.crc32(g.encode()) % 10_000 for g in grams]


def plain(docs, target, size=2):
    """doc_id, n_features, weight, score, rank of each (doc_id, text)."""
    found = [(i, *features(t, size)) for i, t in docs]
    raw, aim = Counter(), Counter()
    for _, _, f in found:
        raw.update(f)
    for t in target:
        aim.update(features(t, size)[1])
    s, t = raw.total(), aim.total()
    gain = [math.floor(1000 * math.log((aim[k] + 1) * (s + 10_000) / ((raw[k] + 1) * (t + 10_000)))) for k in range(10_000)]
    out = []
    for i, words, f in found:
        weight = sum(gain[k] for k in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words])
    fit = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    for k, r in enumerate(fit[: len(fit) * 25 // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def got(df):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r.rank) for r in df.collect()), key=str)


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    assert got(queries.op11_importance(spark, DATA)) == plain(docs, target)


def test_odd_rows(spark):
    long = "Alpha beta-Gamma δέλτα 42 " * 30
    docs = [(3, long), (1, None), (None, long + "x"), (2, ""), (2, "  --- !"), (3, long), (7, "one"), (8, "É" * 9), (9, "w " * 5000), (4, "A\x00b\x7fC")]
    docs += [(100 + k, f"{long} number{k}") for k in range(40)]
    schema = "doc_id long, text string, Weight string, score int"
    table = spark.createDataFrame([(i, t, "w", 1) for i, t in docs], schema)
    target = spark.createDataFrame([(1, "alpha beta gamma"), (2, None)], "item_id long, text string")
    for size in (1, 2, 3):
        assert got(importance.draw(table, target, size=size)) == plain(docs, ["alpha beta gamma", None], size)
    drawn = importance.resample(table, target)
    ranks = [r for r in plain(docs, ["alpha beta gamma", None]) if r[4]]
    assert drawn.columns == table.columns and {r.doc_id for r in drawn.collect()} == {r[0] for r in ranks}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(k, "some words here " * 9) for k in range(8)], "doc_id long, text string")
    none = docs.limit(0)
    assert importance.draw(none, docs).count() == 0
    assert got(importance.draw(docs, none)) == plain([(k, "some words here " * 9) for k in range(8)], [])


def test_scan_gives_every_span():
    text = "The  QUICK—brown\tfox, 3 fox".encode()
    for size in (1, 2, 4):
        words, found = importance.scan(text, importance.scanner(size), 10_000)
        assert (words, list(found)) == features(text.decode(), size)
