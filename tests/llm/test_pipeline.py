"""The stages, each on its own input, and the whole run."""

import corpus_pipeline
from cellwright.llm import decontamination, toxicity

from ..conftest import DATA
from .test_text import contamination


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, at = docs.columns, docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.written(stage(spark, at, DATA), "test")
        seen[name] = (at, out)
        assert out.select(*columns).columns == columns
        at = out
    # toxicity: what it drops is what the model scores high, nothing else
    before, after = seen["toxicity"]
    model = toxicity.fit(before, spark.read.parquet(f"{DATA}/labels.parquet"))
    high = {r.doc_id for r in toxicity.score(before, model).where("score >= 0.5").collect()}
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    assert high and ids(before) - ids(after) == high
    # decontamination drops what a plain scan finds
    before, after = seen["benchmark decontamination"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    found = contamination([(r.doc_id, r.text) for r in before.collect()], items)
    assert ids(before) - ids(after) == {i for i, c in found.items() if c[4]}
    assert decontamination.decontaminate(after, spark.read.parquet(f"{DATA}/benchmark.parquet")).count() == after.count()
    # the last keeps all and adds a rate
    before, after = seen["mixing to target weights"]
    assert ids(before) == ids(after) and "rate" in after.columns
    whole = {(r.doc_id, r.text, round(r.rate, 6)) for r in corpus_pipeline.run(spark, DATA).collect()}
    assert whole == {(r.doc_id, r.text, round(r.rate, 6)) for r in at.collect()}
