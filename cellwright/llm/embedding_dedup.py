"""Near-duplicate embeddings by collision-counting projections.

Each vector is projected on many random lines. On a line, the vectors of a block are sorted, and a
query collides with those in a window centred on it. Vectors that collide often enough are candidates
and verified by cosine in double precision. The window and the count are set so that a pair at the
threshold passes with the asked probability.

Vectors are compared within a label only. A label is dealt into blocks of hashed vectors, and each
pair of blocks is one small group, whatever the label's size. Equal vectors are one, with a weight.
A group gives one row for each vector that links there, with how many others and the smallest vector
that its links reach, and not one for each link: a crowd of n near copies gives no n * n rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import erf, lgamma, log, log1p, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, small, written

COSINE, LINES, RECALL, BLOCK = 0.93, 48, 0.9999, 1024


def window_and_count(cosine: float, lines: int, recall: float) -> tuple[float, int]:
    """Half a window and the fewest collisions: unit vectors at that cosine lie sqrt(2 - 2 cosine)
    apart, so their projections on a normal random line differ by a normal variable of that deviation.
    Of the windows tried, the one that passes fewest pairs at a right angle."""
    near, far = sqrt(2 - 2 * cosine), sqrt(2.0)
    best = None
    for half in np.linspace(0.5, 3.0, 26) * near:
        p, q = erf(half / near / sqrt(2)), erf(half / far / sqrt(2))
        tail = lambda p, k: sum(np.exp(lgamma(lines + 1) - lgamma(i + 1) - lgamma(lines - i + 1) + i * log(p) + (lines - i) * log1p(-p)) for i in range(k, lines + 1))
        count = max((k for k in range(1, lines + 1) if tail(p, k) >= recall), default=0)
        cost = tail(q, count) if count else 1.0
        if best is None or cost < best[0]:
            best = (cost, float(half), count)
    return best[1], best[2]


def collisions(x: np.ndarray, y: np.ndarray, half: float) -> np.ndarray:
    """How often each row of x, as a query, collides with each row of y: both hold projections, a
    column for each line."""
    out = np.zeros((len(x), len(y)), np.uint8)
    for k in range(x.shape[1]):
        order = np.argsort(y[:, k], kind="stable")
        line = y[order, k]
        low, high = np.searchsorted(line, x[:, k] - half, "left"), np.searchsorted(line, x[:, k] + half, "right")
        for q, (a, b) in enumerate(zip(low, high, strict=True)):
            out[q, order[a:b]] += 1
    return out


def _unit(embedding: list) -> np.ndarray | None:
    if embedding is None or any(v is None for v in embedding):
        return None
    v = np.array(embedding, np.float64)
    size = np.abs(v).max(initial=0.0)
    return v if size > 0 and np.isfinite(size) else None


def _links(a: np.ndarray, b: np.ndarray, lines: np.ndarray, half: float, count: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    counts = collisions(a @ lines, b @ lines, half)
    left, right = np.nonzero(counts >= count)
    keep = np.zeros(len(left), bool)
    for at in range(0, len(left), 65536):
        s = slice(at, at + 65536)
        keep[s] = np.einsum("ij,ij->i", a[left[s]], b[right[s]]) >= cosine
    return left[keep], right[keep]


def reached(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """For each of n places the smallest one that the links (u, v) reach."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[u], root[v])
        now = root.copy()
        np.minimum.at(now, root[u], least)
        np.minimum.at(now, root[v], least)
        now = now[now]
        if (now == root).all():
            return root
        root = now


def links(vectors: DataFrame, cosine: float = COSINE, lines: int = LINES, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """(node, root, others) of the nodes of vectors (node, label, unit, copies) that link with others, their
    cosine being at least that: a row for each pair of blocks where a node does, with the copies that its
    partners there have together and the smallest node that links there reach. unit is an array of doubles
    of length 1; nodes of unlike length do not link. Candidates can miss a pair at the threshold with
    probability 1 - recall, and fewer the more alike it is."""
    half, count = window_and_count(cosine, lines, recall)

    def linked(pdf: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({c: pd.Series(dtype="int64") for c in ("node", "root", "others")})]
        for _, same in pdf.groupby(pdf["unit"].map(len)):
            same = same.sort_values("node")
            unit = np.stack(same["unit"].to_numpy())
            axes = np.random.default_rng(11).normal(size=(unit.shape[1], lines))
            node, side, copies = (same[c].to_numpy() for c in ("node", "block", "copies"))
            one, two = same["one"].iloc[0], same["two"].iloc[0]
            i, j = np.flatnonzero(side == one), np.flatnonzero(side == two)
            if len(i) and len(j):
                p, q = _links(unit[i], unit[j], axes, half, count, cosine)
                u, v = i[p], j[q]
                if one == two:
                    u, v = u[u < v], v[u < v]
                others = (np.bincount(u, copies[v], len(node)) + np.bincount(v, copies[u], len(node))).astype(np.int64)
                some = others > 0
                out.append(pd.DataFrame({"node": node[some], "root": node[reached(u, v, len(node))][some], "others": others[some]}))
        return pd.concat(out)

    sizes = vectors.groupBy("label").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = vectors.join(small(sizes), "label").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int"))
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    each = dealt.select("label", "node", "unit", "copies", "block", F.explode(other).alias("other"))
    each = each.select("label", "node", "unit", "copies", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
    return each.groupBy("label", "one", "two").applyInPandas(linked, "node long, root long, others long")


def near_duplicates(embeddings: DataFrame, **how) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of embeddings (vec_id, embedding, label).

    Two rows link if their labels are equal and not null and their cosine is at least the threshold.
    Vectors that are null, empty, zero or hold null or non-finite components link with nothing.
    n_links counts other rows, so copies count each; component_id is the smallest vec_id that links
    reach. Rows that repeat a vec_id are separate vectors of one id. A row without vec_id takes part
    in no link, has a null component and is kept. An empty table gives an empty one."""

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for e in batch.column(2).to_pylist():
                v = _unit(e)
                if v is not None:
                    v = v / np.abs(v).max()
                    v = v / np.sqrt((v * v).sum())
                out.append(v)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.float64()))], ["vec_id", "label", "unit"])

    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    units = rows.where("vec_id is not null and label is not null").mapInArrow(unit, "vec_id long, label string, unit array<double>").where("unit is not null")
    units = written(units.withColumn("digest", F.sha2(F.to_json("unit"), 256)), "units")
    heads = units.groupBy("label", "digest").agg(F.min("vec_id").alias("head"), F.count("*").alias("copies"))
    heads = written(heads.withColumn("node", F.monotonically_increasing_id()), "heads")
    one = units.join(heads, ["label", "digest"]).where("vec_id = head").dropDuplicates(["node"]).select("node", "label", "unit", "copies")
    pair = written(links(one, **how), "links")
    degree = pair.groupBy("node").agg(F.sum("others").alias("others"))
    group = components(pair, "node", "root")
    known = heads.join(group, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = known.groupBy("component").agg(F.min("head").alias("component_id"))
    known = known.join(least, "component").join(degree, "node", "left")
    known = known.select("label", "digest", (F.coalesce("others", F.lit(0).cast("long")) + F.col("copies") - 1).alias("n_links"), "component_id")
    linked = units.select("vec_id", "label", "digest").join(known, ["label", "digest"]).select("vec_id", "n_links", "component_id")
    # what links with nothing: the rows that made no unit vector
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(_usable("embedding"), F.lit(False))
    alone = rows.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.union(alone)
    return out.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _usable(column: str):
    """Whether _unit gives a vector: some component is not zero, and none is null or not finite."""
    finite = F.forall(column, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return finite & F.exists(column, lambda v: v != 0)
