"""Token ids as raw binary shards, with a minimal perfect hash from document keys to places in them.

A store is a folder of three parts:

    shards/   raw ids, little-endian, of two bytes each if the vocabulary allows, else of four. Documents lie one after
              the other in ascending order of doc_id, each followed by the end id. Behind them a shard has
              a directory (keys and lengths, as an Arrow stream), its length in eight bytes, a mark of eight.
    index/    blocks of about BLOCK keys: the hash's bits and, in the order of its numbers, fingerprint,
              shard, offset and length of each key
    shape/    one row: bytes of an id, end id, blocks; and the shards' first ids in starts/

Shards are written by Spark's text writer, whose line separator is the end id, so that only the files of tasks
that committed are seen. A key is found by its block, one hash and one fingerprint, and its ids by one read at
their offset, however large the store is. What is read goes through the file system that the path names.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.footers import open_file
from .common import small, written
from .perfect_hash import PerfectHash

#: Bytes of text of a shard, keys of a block, bytes that are read at once.
SHARD, BLOCK, READ = 8 << 20, 1024, 4 << 20
#: Characters of distinct words whose ids a worker keeps, and bytes of texts that it encodes at a time.
KEEP, STEP = 4 << 20, 8 << 20
_MARK = b"idshard1"
#: A letter or digit that stays one letter in lower case, and a mark of ASCII but the apostrophe.
_BEFORE_MARK = r"([0-9A-Za-zÀ-ÖØ-öø-ÿ])([!-&(-/:-@])"

Encoder = Callable[[pa.Array], pa.Array]


class Words:
    """The ids of texts by a tokenizer that drops white space, lower-cases and never lets a token hold letters and
    marks, such as word_bpe: texts are cut at white space and between a letter or digit and a mark, and each distinct piece
    is encoded once by the library. Its ids are kept, within a bound, for later texts."""

    def __init__(self, path: str, width: int):
        from tokenizers import Tokenizer

        self.tokenizer, self.kind = Tokenizer.from_file(path), np.dtype("<u2" if width == 2 else "<u4")
        plain = [(i, t.content) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not (t.lstrip or t.rstrip or t.normalized or t.single_word)]
        self.mark = plain[0] if plain else None
        self.known: dict[str, bytes] = {}
        self.held = 0

    def _learn(self, words: list[str]) -> None:
        """Words are encoded in rows, a special token between two; those that may hold one themselves alone."""
        size = self.kind.itemsize
        odd = [w for w in words if self.mark is None or "<" in w]
        rest = [w for w in words if "<" not in w] if self.mark else []
        for at in range(0, len(odd), 4096):
            for word, e in zip(odd[at : at + 4096], self.tokenizer.encode_batch_fast(odd[at : at + 4096], add_special_tokens=False)):
                self.known[word] = np.array(e.ids, self.kind).tobytes()
        for at in range(0, len(rest), 2048):
            part = rest[at : at + 2048]
            [row] = self.tokenizer.encode_batch_fast([self.mark[1].join(part)], add_special_tokens=False)
            ids = np.array(row.ids, np.int64)
            stops = [*np.flatnonzero(ids == self.mark[0]).tolist(), len(ids)]
            raw, begin = ids.astype(self.kind).tobytes(), 0
            for word, stop in zip(part, stops, strict=True):
                self.known[word] = raw[begin * size : stop * size]
                begin = stop + 1
        self.held += sum(map(len, words))

    def __call__(self, texts: pa.Array) -> pa.Array:
        if self.held > KEEP:
            self.known, self.held = {}, 0
        # A-Z can be lower-cased before the tokenizer does it, save where accents join letters or a special token may stand
        odd = pc.match_substring_regex(texts, r"\p{M}|<\|")
        texts = pc.replace_substring(pc.if_else(odd, texts, pc.ascii_lower(texts)), "\n", " ")
        texts = pc.replace_substring_regex(texts, _BEFORE_MARK, r"\1 \2")
        split = pc.split_pattern(texts, " ")
        codes = split.flatten().dictionary_encode()
        words = codes.dictionary.to_pylist()
        self._learn([w for w in words if w not in self.known])
        ids = [self.known[w] for w in words]
        raw, length = np.frombuffer(b"".join(ids), self.kind), np.array([len(x) for x in ids], np.int64) // self.kind.itemsize
        first = np.cumsum(length) - length
        at = codes.indices.to_numpy()
        n = length[at]
        stop = np.concatenate([[0], np.cumsum(n)])
        out = raw[np.arange(stop[-1]) + np.repeat(first[at] - stop[:-1], n)] if len(raw) else raw
        edges = (stop[split.offsets.to_numpy()] * self.kind.itemsize).astype(np.int64)
        return pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(out))]).cast(pa.binary())


class Texts:
    """The ids of texts by any tokenizer of the library, each encoded whole."""

    def __init__(self, path: str, width: int):
        from tokenizers import Tokenizer

        self.tokenizer, self.kind = Tokenizer.from_file(path), np.dtype("<u2" if width == 2 else "<u4")

    def __call__(self, texts: pa.Array) -> pa.Array:
        ids = []
        for begin in range(0, len(texts), 16):
            found = self.tokenizer.encode_batch_fast(texts.slice(begin, 16).to_pylist(), add_special_tokens=False)
            ids += [np.array(e.ids, self.kind).tobytes() for e in found]
        return pa.array(ids, pa.binary())


_ENCODERS: dict[tuple, Encoder] = {}


def _encoder(path: str, width: int, by_words: bool) -> Encoder:
    """The worker's encoder: what it has learnt serves later tasks of the worker too."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    key = (path, width, by_words)
    if key not in _ENCODERS:
        _ENCODERS[key] = (Words if by_words else Texts)(path, width)
    return _ENCODERS[key]


def steps(length: list[int], size: int = STEP) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about size in all; a longer text is one of its own."""
    begin, held = 0, 0
    for k, n in enumerate(length):
        if k > begin and held + n > size:
            yield begin, k
            begin, held = k, 0
        held += n
    if begin < len(length):
        yield begin, len(length)


def hashed(keys: DataFrame, blocks: int) -> DataFrame:
    """keys with h1, h2 and the block of (doc_id, copy)."""
    name = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("null"))
    h1, h2 = F.xxhash64(name, "copy"), F.xxhash64("copy", name, F.lit("second"))
    return keys.withColumns({"h1": h1, "h2": h2}).withColumn("block", F.pmod(F.xxhash64("h1", "h2"), F.lit(blocks)).cast("int"))


def _uint(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64).view(np.uint64)


def _build(entries: pa.Table) -> pa.Table:
    """One row of the index: a block's hash, and the places of its keys in the order of their numbers."""
    h1, h2 = _uint(entries["h1"]), _uint(entries["h2"])
    perfect = PerfectHash.build(h1, h2)
    order = np.argsort(perfect.find(h1, h2))
    put = lambda x, kind: np.ascontiguousarray(x[order], kind).tobytes()
    value = lambda c: entries[c].to_numpy()
    row = {
        "block": entries["block"][0].as_py(), "sizes": perfect.sizes, "bits": perfect.packed(), "prints": put(h2 >> np.uint64(32), "<u4"),
        "shards": put(value("shard"), "<u4"), "offsets": put(value("offset"), "<u8"), "lengths": put(value("n"), "<u4"),
    }
    return pa.Table.from_pylist([row], schema=_INDEX)


_INDEX = pa.schema([
    ("block", pa.int32()), ("sizes", pa.list_(pa.int32())), ("bits", pa.binary()), ("prints", pa.binary()), ("shards", pa.binary()), ("offsets", pa.binary()),
    ("lengths", pa.binary()),
])


@dataclass
class IdStore:
    """A store that is written. width: bytes of an id; blocks: of the index."""

    spark: SparkSession
    path: str
    width: int
    end_id: int
    blocks: int

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> IdStore:
        r = spark.read.parquet(f"{path}/shape").first()
        return cls(spark, path, r["width"], r["end_id"], r["blocks"])

    @classmethod
    def write(cls, docs: DataFrame, path: str, tokenizer: str, end_id: int, by_words: bool = False, width: int | None = None) -> IdStore:
        """Encode docs (doc_id, text) into a new store at path, a folder that all executors see.

        by_words: the tokenizer drops white space, so words are encoded one by one (the same ids). A null
        text is an empty one, of the end id alone. Rows of a null doc_id come first; rows that repeat a doc_id lie side by
        side, in the order of their texts' hashes, and are copies 0, 1, 2... of that key, however many shards they fill. An
        empty table gives a store without shards. Other columns are ignored."""
        spark = docs.sparkSession
        if width is None:
            from tokenizers import Tokenizer

            width = 2 if max(Tokenizer.from_file(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        at = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), F.xxhash64("text").alias("h"))
        total = docs.agg(F.sum(F.octet_length("text").cast("long") + 16).alias("n")).first()["n"] or 0
        at = at.repartitionByRange(max(1, -(-total // SHARD)), F.asc_nulls_first("doc_id"), "h")
        at = at.sortWithinPartitions(F.asc_nulls_first("doc_id"), "h")

        def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            encoder = _encoder(tokenizer, width, by_words)
            keys, lengths = [], []
            for batch in batches:
                keys.append(batch["doc_id"])
                for begin, stop in steps(pc.binary_length(batch["text"]).to_pylist()):
                    ids = encoder(batch["text"].slice(begin, stop - begin))
                    lengths.append(pc.binary_length(ids).to_numpy().astype(np.int64) // width + 1)
                    yield pa.RecordBatch.from_arrays([ids], names=["ids"])
            if lengths:
                sink = pa.BufferOutputStream()
                table = pa.table({"doc_id": pa.chunked_array(keys), "n": pa.array(np.concatenate(lengths))})
                with pa.ipc.new_stream(sink, table.schema) as out:
                    out.write_table(table)
                raw = sink.getvalue().to_pybytes()
                yield pa.RecordBatch.from_arrays([pa.array([raw + struct.pack("<Q", len(raw)) + _MARK], pa.binary())], names=["ids"])

        raw = at.select("doc_id", "text").mapInArrow(encode, "ids binary").select(F.col("ids").cast("string"))
        end = int(end_id).to_bytes(width, "little").decode("latin-1")
        raw.write.option("encoding", "ISO-8859-1").option("lineSep", end).text(f"{path}/shards")

        store = cls(spark, path, width, end_id, 1)
        entries = written(store.directories(docs.schema["doc_id"].dataType.simpleString()), "entries")
        shards = entries.groupBy("shard").agg(F.max("path").alias("path"), F.sum("n").alias("n"), F.count("*").alias("keys"))
        before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
        shards = shards.select("shard", "path", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), "keys")
        shards.coalesce(1).write.parquet(f"{path}/starts")
        keys = spark.read.parquet(f"{path}/starts").agg(F.sum("keys").alias("n")).first()["n"] or 0
        store.blocks = max(1, -(-keys // BLOCK))

        # copies of a key that began in an earlier shard: at most the first run of each shard
        runs = entries.where("edge").groupBy("doc_id", "shard").agg(F.count("*").alias("n"))
        run = Window.partitionBy("doc_id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        earlier = runs.select(F.col("doc_id").alias("d"), F.col("shard").alias("s"), F.sum("n").over(run).alias("more")).where("more > 0")
        entries = entries.join(small(earlier), entries["doc_id"].eqNullSafe(F.col("d")) & (entries["shard"] == F.col("s")), "left")
        entries = entries.select("doc_id", (F.col("copy") + F.coalesce("more", F.lit(0))).alias("copy"), "shard", "offset", "n")
        placed = hashed(entries, store.blocks).select("block", "h1", "h2", "shard", "offset", "n")
        schema = "block int, sizes array<int>, bits binary, prints binary, shards binary, offsets binary, lengths binary"
        placed.groupBy("block").applyInArrow(_build, schema).write.parquet(f"{path}/index")
        spark.createDataFrame([(width, end_id, store.blocks)], "width int, end_id long, blocks int").coalesce(1).write.parquet(f"{path}/shape")
        return store

    def directories(self, key_type: str) -> DataFrame:
        """(shard, path, doc_id, copy, offset, n, edge) of each document, read from the ends of the shards: copy counts rows
        of a key within the shard, edge marks the first and the last key of it."""
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{self.path}/shards")
        files = files.where("length > 0").select("path", "length", F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("shard"))
        width = self.width

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in batch.to_pylist():
                    with open_file(r["path"]) as f:
                        size, mark = struct.unpack("<Q8s", f.read_at(16, r["length"] - width - 16))
                        if mark != _MARK:
                            raise ValueError(f"{r['path']} is no shard of ids")
                        table = pa.ipc.open_stream(f.read_at(size, r["length"] - width - 16 - size)).read_all().combine_chunks()
                    n = table["n"].to_numpy()
                    key = table["doc_id"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
                    new = np.flatnonzero(np.diff(key, prepend=-1))
                    copy = np.arange(len(n)) - np.repeat(new, np.diff(new, append=len(n)))
                    columns = {
                        "shard": pa.array(np.full(len(n), r["shard"], np.int32)), "path": pa.array([r["path"]] * len(n)), "doc_id": table["doc_id"].combine_chunks(),
                        "copy": pa.array(copy), "offset": pa.array(np.cumsum(n) - n), "n": table["n"].combine_chunks(),
                        "edge": pa.array((key == key[0]) | (key == key[-1])),
                    }
                    yield from pa.table(columns).to_batches(max_chunksize=10_000)

        return files.mapInArrow(read, f"shard int, path string, doc_id {key_type}, copy long, offset long, n long, edge boolean")

    def locate(self, keys: DataFrame) -> DataFrame:
        """(doc_id, copy, shard, offset, n) of each distinct (doc_id, copy) of keys, the last three null for one that the
        store does not have. One that it does not have passes for another with a probability of 2**-32."""
        asked = hashed(keys.select("doc_id", F.col("copy").cast("long").alias("copy")).distinct(), self.blocks)
        index = self.spark.read.parquet(f"{self.path}/index")
        index = index.join(small(asked.select("block").distinct()), "block", "left_semi")

        def find(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            n = len(left)
            slot = np.full(n, -1, np.int64)
            if len(right) and n:
                r = right.to_pylist()[0]
                h2 = _uint(left["h2"])
                slot = PerfectHash.load(r["sizes"], r["bits"]).find(_uint(left["h1"]), h2)
                prints = np.frombuffer(r["prints"], "<u4")
                slot = np.where((slot >= 0) & (prints[slot] == h2 >> np.uint64(32)), slot, -1)
                value = lambda c, kind: np.frombuffer(r[c], kind)[slot].astype(np.int64)
                found = [value("shards", "<u4"), value("offsets", "<u8"), value("lengths", "<u4")]
            else:
                found = [np.zeros(n, np.int64)] * 3
            out = [pa.array(x, pa.int64(), mask=slot < 0) for x in found]
            return pa.table({"doc_id": left["doc_id"], "copy": left["copy"], "shard": out[0].cast(pa.int32()), "offset": out[1], "n": out[2]})

        kind = keys.schema["doc_id"].dataType.simpleString()
        return asked.groupBy("block").cogroup(index.groupBy("block")).applyInArrow(find, f"doc_id {kind}, copy long, shard int, offset long, n long")

    def read(self, located: DataFrame) -> DataFrame:
        """(doc_id, copy, start, n, ids) of what locate has found: ids are the document's, the end id included, in four bytes
        each, little-endian; start counts the ids of all documents before it. Ranges that lie near each other are one read."""
        starts = self.spark.read.parquet(f"{self.path}/starts").select("shard", "path", "base")  # a row for each shard
        at = located.where("shard is not null").join(small(starts), "shard")
        at = at.repartitionByRange("shard", "offset").sortWithinPartitions("shard", "offset")
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            path, f = None, None
            for batch in batches:
                offset, n = batch["offset"].to_numpy(), batch["n"].to_numpy()
                paths, begin = batch["path"].to_pylist(), 0
                while begin < len(batch):
                    stop = begin + 1
                    while stop < len(batch) and paths[stop] == paths[begin] and (offset[stop] + n[stop] - offset[begin]) * width <= READ:
                        stop += 1
                    if paths[begin] != path:
                        if f is not None:
                            f.close()
                        path, f = paths[begin], open_file(paths[begin])
                    first = offset[begin]
                    raw = np.frombuffer(f.read_at(int(offset[stop - 1] + n[stop - 1] - first) * width, int(first) * width), f"<u{width}").astype("<u4")
                    ids = [raw[o : o + k].tobytes() for o, k in zip(offset[begin:stop] - first, n[begin:stop])]
                    part = batch.slice(begin, stop - begin)
                    start = pa.array(part["base"].to_numpy() + part["offset"].to_numpy())
                    yield pa.RecordBatch.from_arrays([part["doc_id"], part["copy"], start, part["n"], pa.array(ids, pa.binary())], names=["doc_id", "copy", "start", "n", "ids"])
                    begin = stop
            if f is not None:
                f.close()

        kind = located.schema["doc_id"].dataType.simpleString()
        at = at.select("doc_id", "copy", "offset", "n", "path", "base")
        return at.mapInArrow(run, f"doc_id {kind}, copy long, start long, n long, ids binary")

    def lookup(self, keys: DataFrame) -> DataFrame:
        """read of locate: the ids of each key that the store has. keys: doc_id and copy (0 for the first row of a doc_id)."""
        return self.read(self.locate(keys))
