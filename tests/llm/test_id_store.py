"""Stores of ids: exact round trips, keyed access, odd rows; and the perfect hash by itself."""

import os
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cellwright.llm import id_store, queries
from cellwright.llm.perfect_hash import PerfectHash

from ..conftest import DATA

PATH = public_tokenizers.path("word_bpe_49k.json")


TOKENIZER, ENCODER = Tokenizer.from_file(PATH), id_store.Words(PATH, 2)


@pytest.fixture(scope="module")
def tokenizer():
    return TOKENIZER


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_whole_table(spark, tokenizer):
    expected, at = set(), 0
    for r in sorted(spark.read.parquet(f"{DATA}/documents.parquet").collect(), key=lambda r: r.doc_id):
        ids = ids_of(tokenizer, r.text)
        expected.add((r.doc_id, at, len(ids), crc(ids)))
        at += len(ids)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in queries.op12_id_store(spark, DATA).collect()]
    assert len(got) == len(expected) and set(got) == expected


ODD = [
    (5, "plain words, 42 of them"), (None, "no id"), (3, None), (3, ""), (9, "same id " * 40), (9, "Same ID again"), (9, None), (9, "same id " * 40),
    (1, "a b c\x85d\x1ce  f\t\n ǵ ́x"), (2, "<|endoftext|> it's I'LL don't<|startoftext|>x"), (4, "한국어 Å \U0001f600‍\U0001f600 ΣΑΣ"),
    (6, "x" * 50_000), (7, ("word " * 9 + "\n") * 3000), (None, "no id"),
]


def test_odd_rows_fill_several_shards(spark, tokenizer, tmp_path, monkeypatch):
    monkeypatch.setattr(id_store, "SHARD", 400)  # so that rows of one doc_id fill more than one
    monkeypatch.setattr(id_store, "BLOCK", 4)
    rows = ODD + [(9, f"copy {k} of nine") for k in range(60)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, Shard int").repartition(3)
    store = id_store.IdStore.write(docs, str(tmp_path / "s"), PATH, 1, by_words=True)
    assert len([f for f in os.listdir(tmp_path / "s/shards") if f.startswith("part-") and os.path.getsize(tmp_path / "s/shards" / f)]) > 3
    again = id_store.IdStore.open(spark, str(tmp_path / "s"))
    assert again == store and store.width == 2 and store.blocks > 4
    keys = docs.groupBy("doc_id").agg(F.count("*").alias("n")).select("doc_id", F.explode(F.expr("sequence(0L, n - 1)")).alias("copy"))
    got = sorted(again.lookup(keys).collect(), key=lambda r: r.start)
    assert len(got) == len(rows) == len({(r.doc_id, r.copy) for r in got})
    at, order = 0, []
    for r in got:  # one after the other, without a gap, each the ids of a text of its key
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == at and r.n == len(ids)
        at += r.n
        order.append(-1 if r.doc_id is None else r.doc_id)
    assert order == sorted(order)
    plain = sorted((-1 if i is None else i, ids_of(tokenizer, t)) for i, t in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in got) == plain
    for i in {r.doc_id for r in got}:  # copies are numbered in the order of the file
        mine = [r.copy for r in got if r.doc_id == i]
        assert mine == list(range(len(mine)))


def test_missing_keys_and_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(500)], "doc_id long, text string")
    store = id_store.IdStore.write(docs, str(tmp_path / "s"), PATH, 1)
    asked = spark.createDataFrame([(7, 0), (7, 1), (None, 0), (500, 0), (-1, 0), (7, 0)], "doc_id long, copy long")
    found = {(r.doc_id, r.copy): r.n for r in store.locate(asked).collect()}
    assert found.pop((7, 0)) == 3 and set(found.values()) == {None} and len(found) == 4
    assert [r.doc_id for r in store.lookup(asked).collect()] == [7]
    none = id_store.IdStore.write(docs.limit(0), str(tmp_path / "none"), PATH, 1)
    assert none.lookup(asked).count() == 0 and none.locate(asked).count() == 5


def test_wide_ids_and_texts_encoded_whole(spark, tmp_path):
    """A tokenizer that keeps spaces, four bytes for an id and an end id whose bytes are no text."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.createDataFrame([(2, "two  spaces\n"), (1, None), (3, "x")], "doc_id long, text string")
    store = id_store.IdStore.write(docs, str(tmp_path / "s"), path, 50256, width=4)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in store.lookup(docs.select("doc_id", F.lit(0).alias("copy"))).collect()}
    plain = Tokenizer.from_file(path)
    assert got == {r.doc_id: [*plain.encode(r.text or "").ids, 50256] for r in docs.collect()}


@settings(deadline=None, max_examples=400)
@given(st.lists(st.text(st.sampled_from("ab'sSJ1 .,!\n\t\u0301\u030c\u0307\u0338é한😀<|endoftxE>İß\x00"), max_size=40), max_size=4))
def test_words_are_encoded_as_in_their_text(texts):
    expected = [np.array(TOKENIZER.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    array = pa.array(texts, pa.string())
    assert ENCODER(array).to_pylist() == expected


def test_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 20_000):
        h1, h2 = rng.integers(0, 1 << 63, (2, n), np.int64).astype(np.uint64)
        h1[: n // 2] %= np.uint64(7)  # the second hash tells apart what the first does not
        made = PerfectHash.build(h1, h2)
        made = PerfectHash.load(made.sizes, made.packed())
        assert sorted(made.find(h1, h2)) == list(range(n))
        assert len(made.bits) < 5 * n + 200
    with pytest.raises(ValueError):
        PerfectHash.build(np.ones(2, np.uint64), np.ones(2, np.uint64))
