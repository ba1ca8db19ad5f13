"""Target-distribution importance resampling: documents are drawn by how much their n-grams look like a target's.

A text is lower-cased (A-Z), its separators are collapsed to single spaces, and one overlapped regex scan
emits, at each word, the spans of all n-grams that begin there; the crc32 of a span's bytes names its
bucket. Counts by bucket of raw and target texts give each bucket a log-ratio, a document the mean of its
features' gains, and Gumbel noise of its own (a hash of seed and doc_id) makes the highest scores a weighted draw without
replacement. Each text is scanned once: its buckets are written, two bytes each, and read for counts and for weights.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import written

#: Documents of fewer words are not drawn.
MIN_WORDS = 20
_WORD = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
#: A-Z to a-z, bytes of words unchanged, all others to a space.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _WORD else 0x20 for b in range(256))
_TABLE = "doc_id {}, uid long, n_words long, n_features long, buckets binary"


def scanner(size: int) -> regex.Pattern:
    """Matches, at the start of a word, the longest run of 1 to size words; group k is what the kth word adds to it."""
    more = rb"(?:( [^ ]++)" * (size - 1) + rb")?" * (size - 1)
    return regex.compile(rb"(?<![^ ])([^ ]++)" + more + rb"(?![^ ])")


def collapse(text: bytes) -> bytes:
    """The words of a text, A-Z lower-cased, with single spaces between them."""
    return b" ".join(text.translate(_FOLD).split())


def scan(text: bytes, pattern: regex.Pattern, buckets: int) -> tuple[int, array]:
    """The number of words and the bucket of every n-gram, in the order of their places."""
    words, out = 0, array("H")
    put, groups = out.append, pattern.groups
    line = collapse(text)
    if groups == 2:  # the usual case, without an inner loop
        for m in pattern.finditer(line, overlapped=True):
            words += 1
            begin, stop = m.span(1)
            crc = crc32(line[begin:stop])
            put(crc % buckets)
            end = m.end()
            if end > stop:
                put(crc32(line[stop:end], crc) % buckets)
        return words, out
    for m in pattern.finditer(line, overlapped=True):
        words += 1
        crc = 0
        for k in range(1, groups + 1):
            begin, stop = m.span(k)
            if begin < 0:
                break
            crc = crc32(line[begin:stop], crc)
            put(crc % buckets)
    return words, out


def features(docs: DataFrame, size: int = 2, buckets: int = 10_000) -> DataFrame:
    """(doc_id, uid, n_words, n_features, buckets) of each document: buckets holds two bytes for each feature, in
    the order of the text. uid names the row. A null text has no words."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("a bucket is written in two bytes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = scanner(size)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                found = [scan(t.as_buffer().to_pybytes() if t.is_valid else b"", pattern, buckets) for t in part["text"]]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["uid"], pa.array([w for w, _ in found], pa.int64()), pa.array([len(f) for _, f in found], pa.int64()),
                     pa.array([f.tobytes() for _, f in found], pa.binary())], names=["doc_id", "uid", "n_words", "n_features", "buckets"],
                )

    at = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("uid"))
    return at.mapInArrow(run, _TABLE.format(docs.schema["doc_id"].dataType.simpleString()))


def bucket_counts(found: DataFrame, buckets: int = 10_000) -> DataFrame:
    """(bucket, n): how often each bucket occurs, counted within each task before rows are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for row in batch["buckets"]:
                total += np.bincount(np.frombuffer(row.as_buffer(), np.uint16), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    return found.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = 10_000) -> DataFrame:
    """(bucket, gain) of every bucket: 1000 times the log of the ratio of its smoothed shares, floored."""
    both = raw.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).union(
        target.select("bucket", F.lit(0).cast("long"), "n")
    )
    all_of = both.sparkSession.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("t"))
    each = both.union(all_of).groupBy("bucket").agg(F.sum("s").cast("double").alias("s"), F.sum("t").cast("double").alias("t"))
    total = each.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    ratio = (F.col("t") + 1) * (F.col("all_s") + buckets) / ((F.col("s") + 1) * (F.col("all_t") + buckets))
    return each.crossJoin(F.broadcast(total)).select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def weigh(found: DataFrame, gain: DataFrame, buckets: int = 10_000) -> DataFrame:
    """(doc_id, uid, n_words, n_features, weight): the floored mean of the gains of a document's features, 0 without any.
    The gains, a number for each bucket, come to the driver and go out with the tasks."""
    by_bucket = np.zeros(buckets, np.int64)
    for r in gain.collect():  # as many as there are buckets
        by_bucket[r["bucket"]] = r["gain"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [int(by_bucket[np.frombuffer(row.as_buffer(), np.uint16)].sum()) for row in batch["buckets"]]
            weight = [s // n if n else 0 for s, n in zip(sums, batch["n_features"].to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(weight, pa.int64())], names=["doc_id", "uid", "n_words", "n_features", "weight"])

    kind = found.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(run, f"doc_id {kind}, uid long, n_words long, n_features long, weight long")


def noise(seed: int) -> F.Column:
    """Gumbel noise of a document, times 1000 and floored: a hash of seed and doc_id, a null id being the empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(weighed: DataFrame, percent: int = 25, seed: int = 7, min_words: int = MIN_WORDS) -> DataFrame:
    """weighed with score and rank: of the N documents with at least min_words words the floor(percent * N / 100) with the
    highest scores have ranks 1, 2, 3..., ties to the smaller doc_id; all others have none.

    Rows are sorted once, by ranges; a row's rank is its place in its range after the rows of the ranges before, of
    which only the sizes are added up."""
    at = weighed.withColumn("score", F.col("weight") + noise(seed)).withColumn("open", F.col("n_words") >= min_words)
    order = [F.desc("open"), F.desc("score"), F.asc("doc_id"), F.asc("n_features"), F.asc("uid")]
    at = written(at.orderBy(*order).withColumn("place", F.monotonically_increasing_id()), "ranked")
    part, inner = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)  # as that function is defined
    sizes = at.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.sum(F.col("open").cast("long")).alias("n_open"))
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    base = sizes.select("part", F.coalesce(F.sum("n").over(whole), F.lit(0)).alias("base"))
    drawn = sizes.agg(F.expr(f"coalesce(sum(n_open), 0) * {int(percent)} div 100").alias("drawn"))
    out = at.withColumn("part", part).join(F.broadcast(base), "part").crossJoin(F.broadcast(drawn))
    rank = inner + F.col("base") + 1
    return out.select(
        "doc_id", "uid", "n_words", "n_features", "weight", "score", F.when(F.col("open") & (rank <= F.col("drawn")), rank).alias("rank")
    )


def draw(docs: DataFrame, target: DataFrame, percent: int = 25, seed: int = 7, size: int = 2, buckets: int = 10_000) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of each row of docs.

    A null or empty text has no features and weight 0; a null doc_id is hashed as the empty text and comes first
    among ties; rows that repeat a doc_id are ranked each. Empty tables give every bucket the gain of its
    smoothed shares, and an empty result where docs is empty. Texts may be of any length; other columns are ignored."""
    found = written(features(docs, size, buckets), "features")
    aim = features(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), size, buckets)
    gain = gains(bucket_counts(found, buckets), bucket_counts(aim, buckets), buckets)
    return ranked(weigh(found, gain, buckets), percent, seed).drop("uid")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, seed: int = 7, size: int = 2, buckets: int = 10_000) -> DataFrame:
    """The rows of docs that are drawn, with all their columns. A doc_id of several rows is drawn whole
    if one of its rows is."""
    ids = draw(docs, target, percent, seed, size, buckets).where("rank is not null").select(F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["_drawn"]), "left_semi")
