"""Mixing documents to target domain weights with soft membership.

A naive Bayes classifier, counted over a labelled table, gives each document a posterior over
domains. Nonnegative rates are then fitted so that the expected tokens of each domain, tokens times
posterior times rate, meet the targets: projected-gradient least squares. A step is one grouping over
all documents; what comes to the driver is one number for each domain, or pair of domains.
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, written

#: Word buckets of the classifier: its table has so many rows whatever the corpus, and a column for each domain.
BUCKETS = 4096
#: Sums that one aggregation over all documents takes at most; the products of many domains take several.
SUMS = 500
#: Tokens that a posterior counts as evidence: more of them would make every document all of one domain.
EVIDENCE = 12.0


def _tokens(text: str) -> Column:
    return F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[\s]+")


def _bucket(word: str) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def train(labelled: DataFrame) -> tuple[DataFrame, list[str], list[float]]:
    """From labelled (text, domain): the table (bucket, l0, l1, ...) of smoothed log-probabilities, the
    domains in order and their shares of the words. Rows with a null domain are skipped."""
    words = labelled.where("domain is not null").select(F.col("domain").cast("string").alias("domain"), F.explode_outer(_tokens("text")).alias("w"))
    counted = written(words.where("w <> ''").groupBy("domain", _bucket("w").alias("bucket")).agg(F.count("*").alias("c")), "buckets")
    totals = {r["domain"]: r["n"] for r in counted.groupBy("domain").agg(F.sum("c").alias("n")).collect()}
    domains = sorted(totals)
    every = labelled.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    wide = counted.groupBy("bucket").agg(*[F.sum(F.when(F.col("domain") == d, F.col("c"))).alias(f"c{k}") for k, d in enumerate(domains)] or [F.sum("c")])
    table = every.join(wide, "bucket", "left").select(
        "bucket", *[F.log((F.coalesce(f"c{k}", F.lit(0)) + 1.0) / float(totals[d] + BUCKETS)).alias(f"l{k}") for k, d in enumerate(domains)]
    )
    n = sum(totals.values())
    return table, domains, [totals[d] / n for d in domains]


def _mark(doc_id: str, text: str) -> Column:
    return F.when(F.col(doc_id).isNull(), F.xxhash64(text))


def posteriors(docs: DataFrame, model: tuple[DataFrame, list[str], list[float]]) -> DataFrame:
    """(doc_id, n_tokens, p0, p1, ...): each document's words and its posterior of each domain, the mean
    word's likelihood raised to at most EVIDENCE words. Without words the posteriors are 0. Rows that
    share a doc_id are one document; of those without one, rows of equal text, which alone have a mark."""
    table, domains, shares = model
    words = docs.select("doc_id", _mark("doc_id", "text").alias("mark"), F.explode_outer(_tokens("text")).alias("w")).withColumn("bucket", _bucket("w"))
    joined = words.join(F.broadcast(table), "bucket")  # BUCKETS rows
    real = F.col("w") != ""
    n = F.sum(real.cast("long"))
    sums = joined.groupBy("doc_id", "mark").agg(n.alias("n_tokens"), *[F.sum(F.when(real, F.col(f"l{k}")).otherwise(0.0)).alias(f"s{k}") for k in range(len(domains))])
    scale = F.least(F.lit(1.0), F.lit(EVIDENCE) / F.greatest(F.col("n_tokens"), F.lit(1)))
    sums = sums.select("doc_id", "mark", "n_tokens", *[(F.col(f"s{k}") * scale + float(np.log(p))).alias(f"s{k}") for k, p in enumerate(shares)])
    top = F.greatest(*[F.col(f"s{k}") for k in range(len(domains))]) if len(domains) > 1 else F.col("s0") if domains else F.lit(0.0)
    sums = sums.select("doc_id", "mark", "n_tokens", *[F.exp(F.col(f"s{k}") - top).alias(f"e{k}") for k in range(len(domains))])
    total = sum((F.col(f"e{k}") for k in range(len(domains))), F.lit(0.0))
    return sums.select("doc_id", "mark", "n_tokens", *[F.when(F.col("n_tokens") > 0, F.col(f"e{k}") / total).otherwise(0.0).alias(f"p{k}") for k in range(len(domains))])


def rate_of(steps: list[np.ndarray], domains: int) -> Column:
    """A document's rate after steps of projected gradient, from 1: each takes the step's vector times
    the posteriors off and cuts at 0."""
    if not steps:
        return F.lit(1.0)
    rows = F.array(*[F.array(*[F.lit(float(x)) for x in v]) for v in steps])
    dot = lambda v: sum((F.col(f"p{k}") * v[k] for k in range(domains)), F.lit(0.0))
    return F.aggregate(rows, F.lit(1.0), lambda r, v: F.greatest(F.lit(0.0), r - dot(v)))


def fit_rates(soft: DataFrame, targets: list[float], tolerance: float = 1e-6, max_steps: int = 60) -> list[np.ndarray]:
    """Steps for rate_of that bring the domains' expected tokens to targets.

    The unknowns are square root of tokens times rate, so that long and short documents move alike,
    and residuals are measured by the inverse of the documents' Gram matrix; the gradient's Lipschitz
    constant is then 1 and a full step is taken each time. The end is reached when every expected
    total is within tolerance of its target, relative to the largest, or after max_steps, which warns
    with what the largest difference then is."""
    k = len(targets)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    gram = []
    for at in range(0, len(pairs), SUMS):
        gram += soft.agg(*[F.sum(F.col("n_tokens") * F.col(f"p{i}") * F.col(f"p{j}")) for i, j in pairs[at : at + SUMS]]).first()
    g = np.zeros((k, k))
    for (i, j), x in zip(pairs, gram, strict=True):
        g[i, j] = g[j, i] = x or 0.0
    inverse, goal, steps = np.linalg.pinv(g, hermitian=True), np.array(targets), []
    for step in range(max_steps + 1 if k else 0):
        rate = rate_of(steps, k)
        now = soft.select("n_tokens", rate.alias("r"), *[f"p{i}" for i in range(k)]).agg(*[F.sum(F.col("n_tokens") * F.col("r") * F.col(f"p{i}")) for i in range(k)]).first()
        off = np.array([x or 0.0 for x in now]) - goal
        if np.abs(off).max() <= tolerance * max(goal.max(), 1.0):
            break
        if step == max_steps:
            left = np.abs(off).max() / max(goal.max(), 1.0)
            warnings.warn(f"mixing targets missed after {max_steps} steps by {left:.3g} of the largest", RuntimeWarning, stacklevel=2)
            break
        steps.append(inverse @ off)
    return steps


def _rates(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(doc_id, n_tokens, domain, posterior, rate) for each document of docs (doc_id, text).

    weights: the share of all tokens that each domain shall have, made to add up to one; domains that
    it lacks get 0, and without it all domains get the same. The sum of tokens is kept. domain is the
    likeliest, posterior its posterior. A document without words, or with a null text, has no domain,
    posterior 0 and rate 1. Rows that share a doc_id are one document and give one row; without a doc_id, rows of
    equal text are. Without
    labelled rows every rate is 1; other columns are ignored; an empty table gives an empty one."""
    model = train(labelled)
    domains = model[1]
    soft = written(posteriors(docs, model), "posteriors")
    total = float(soft.agg(F.sum("n_tokens")).first()[0] or 0)
    share = [1.0 if weights is None else float(weights.get(d, 0.0)) for d in domains]
    targets = [total * s / sum(share) for s in share] if sum(share) > 0 else [0.0] * len(domains)
    steps = fit_rates(soft, targets)
    p = [F.col(f"p{k}") for k in range(len(domains))]
    best = F.greatest(*p) if len(p) > 1 else p[0] if p else F.lit(0.0)
    first = F.array_position(F.array(*p), best).cast("int") if p else F.lit(0)
    name = F.when((F.col("n_tokens") > 0) & (first > 0), F.get(F.array(*[F.lit(d) for d in domains]).cast("array<string>"), first - 1))
    return soft.select("doc_id", "mark", "n_tokens", name.alias("domain"), best.alias("posterior"), rate_of(steps, len(domains)).alias("rate"))


def mixing_rates(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(doc_id, n_tokens, domain, posterior, rate) for each document, see _rates."""
    return _rates(docs, labelled, weights).drop("mark")


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """docs with a column rate, in place of any of that name, in upper or lower case."""
    doc_of, mark_of, rate_of_doc = fresh(docs, "doc_of", "mark_of", "rate_of_doc")
    rates = _rates(docs, labelled, weights).select(F.col("doc_id").alias(doc_of), F.col("mark").alias(mark_of), F.col("rate").alias(rate_of_doc))
    mark = F.when(docs["doc_id"].isNull(), F.xxhash64(docs["text"]))
    both = docs.join(rates, docs["doc_id"].eqNullSafe(rates[doc_of]) & mark.eqNullSafe(rates[mark_of]), "left")
    return both.select(*[docs[c] for c in docs.columns if c.lower() != "rate"], F.col(rate_of_doc).alias("rate"))
