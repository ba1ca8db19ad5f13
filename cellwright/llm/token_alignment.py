"""Alignment of two tokenizers' ids over a corpus, with inverted bitmaps of the documents that link a pair.

Both tokenizers read a space and the text. Where tokens of both end at one byte, the text is cut; between two cuts lies a
group, and the two tokens that end together are a link. A cut before a space that stands between
other characters is one for both, so a text is a row of segments (a space and what follows it) whose tokens,
groups and links do not depend on their neighbours: each distinct segment is encoded once by a worker.

Documents are taken in chunks. In a chunk, an id pair has one bitmap for each binary digit of its link
counts (the documents whose count has that digit), compressed: two bytes for each document while these are few,
a bit for every document of the chunk else. A pair's links are the popcounts, weighed by their digit's worth; its
documents are the popcount of the union of its bitmaps, which is summed over chunks as these share no document. The bitmaps
are the postings: each goes back to its chunk with its pair's count and adds it to its documents.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small, written
from .id_store import steps

#: Documents of a chunk, and links after which it ends before.
CHUNK, CHUNK_LINKS = 4096, 4 << 20
#: Bytes of distinct segments that a worker keeps, and of texts that it encodes at a time.
KEEP, STEP = 4 << 20, 1 << 20
_BITS = CHUNK // 8
#: Two ids in one number.
_HALF = 1 << 32


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones of Latin-1 stand for themselves,
    the others, in their order, for characters from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


#: What must not stand at a cut, as one of the two might join over it: white space after the space, a space or its stand-in before it.
_NO_CUT = re.compile(r" (?=\s|\Z)|(?:\A|[▁]) |\A\Z")


def segments(text: str) -> list[str]:
    """Runs of the text whose tokens do not depend on each other; a space goes between two of them."""
    parts = text.split(" ")
    if not _NO_CUT.search(text):
        return parts
    out = [parts[0]]
    for before, part in zip(parts, parts[1:]):
        if part and not part[0].isspace() and before and before[-1] != "▁":
            out.append(part)
        else:
            out[-1] += " " + part
    return out


class Aligner:
    """What both tokenizers make of segments: for each (tokens of A, tokens of B, groups as text, links as bytes of pairs),
    or None if the bytes of the tokens are not those of the segment."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_alphabet()
        size = self.a.get_vocab_size()
        names = [self.a.id_to_token(i) or "" for i in range(size)]
        self.bytes_a = [bytes(map(alphabet.get, t)) if all(c in alphabet for c in t) else t.encode() for t in names]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces
        ]
        self.known: dict[str, tuple | None] = {}
        self.held = 0

    def _align(self, segment: str, a: list[int], b: list[int]) -> tuple | None:
        plain = b" " + segment.encode()
        parts_a, parts_b = [self.bytes_a[i] for i in a], [self.bytes_b[i] for i in b]
        if b"".join(parts_a) != plain or b"".join(parts_b) != plain:
            return None
        groups, links = [], []
        if len(a) == 1 or len(b) == 1:
            groups.append(f"{','.join(map(str, a))}|{','.join(map(str, b))}")
            links.append(a[-1] * _HALF + b[-1])
        else:
            i = j = from_i = from_j = end_a = end_b = 0
            while i < len(a):
                if end_a <= end_b:
                    end_a += len(parts_a[i])
                    i += 1
                while end_b < end_a:
                    end_b += len(parts_b[j])
                    j += 1
                if end_a == end_b:
                    groups.append(f"{','.join(map(str, a[from_i:i]))}|{','.join(map(str, b[from_j:j]))}")
                    links.append(a[i - 1] * _HALF + b[j - 1])
                    from_i, from_j = i, j
        return len(a), len(b), ";".join(groups), np.array(links, np.int64).tobytes()

    def __call__(self, texts: list[str]) -> list[list[tuple | None]]:
        """What is known of the segments of each text, in their order."""
        if self.held > KEEP:
            self.known, self.held = {}, 0
        split = [segments(t) if t else [] for t in texts]
        new = list(set(chain.from_iterable(split)) - self.known.keys())
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            found = self.a.encode_batch_fast([" " + s for s in part], add_special_tokens=False)
            for s, a, b in zip(part, found, self.b.encode(part, num_threads=1)):
                self.known[s] = self._align(s, a.ids, b)
                self.held += len(s)
        return [list(map(self.known.__getitem__, s)) for s in split]


_ALIGNERS: dict[tuple, Aligner] = {}


def _aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner: what it has learnt serves later tasks of the worker too."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def pack(docs: np.ndarray) -> bytes:
    """A bitmap of sorted numbers below CHUNK: two bytes for each, or a bit for every number where that is shorter."""
    if 2 * len(docs) < _BITS:
        return docs.astype("<u2").tobytes()
    bits = np.zeros(CHUNK, bool)
    bits[docs] = True
    return np.packbits(bits).tobytes()


def unpack(bitmaps: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in all bitmaps, and for each the bitmap that it is in."""
    length = np.array([len(b) for b in bitmaps], np.int64)
    full = np.flatnonzero(length == _BITS)
    few = np.flatnonzero(length != _BITS)
    short = np.frombuffer(b"".join(bitmaps[k] for k in few), "<u2").astype(np.int64)
    at, number = np.nonzero(np.unpackbits(np.frombuffer(b"".join(bitmaps[k] for k in full), np.uint8).reshape(-1, _BITS), axis=1))
    return np.concatenate([short, number]), np.concatenate([np.repeat(few, length[few] // 2), full[at]])


def postings(pair: np.ndarray, doc: np.ndarray) -> pa.RecordBatch:
    """(pair, plane, docs, n, fresh) of the links (pair, doc) of a chunk: plane is the digit, docs the bitmap, n its
    popcount, fresh the number of its documents that no lower plane of the pair has."""
    key, code = np.unique(pair, return_inverse=True)
    both, times = np.unique(code.astype(np.int64) * CHUNK + doc, return_counts=True)
    out, low = [], times & -times
    for plane in range(int(times.max()).bit_length() if len(times) else 0):
        at = both[(times >> plane & 1) == 1]
        first = both[low == 1 << plane]
        code, begin, n = np.unique(at // CHUNK, return_index=True, return_counts=True)
        number, fresh = at % CHUNK, np.bincount(first // CHUNK, minlength=len(key))
        for k, b, m in zip(code.tolist(), begin.tolist(), n.tolist()):
            out.append((key[k], plane, pack(number[b : b + m]), m, fresh[k]))
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64())
    columns = zip(*out) if out else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["pair", "plane", "docs", "n", "fresh"])


_ROWS = "chunk long, number int, doc_id {}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, pair long, plane int, docs binary, n long, fresh long"


def aligned(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = False) -> DataFrame:
    """Rows of two kinds: of documents (chunk, number, doc_id, n_a to groups_sha256, groups if asked for) and of
    postings (chunk, pair, plane, docs, n, fresh), the other columns null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        chunk, rows, links, held = TaskContext.get().partitionId() << 32, [], [], 0

        def close() -> Iterator[pa.RecordBatch]:
            doc = np.repeat(np.arange(len(links)), [len(x) // 8 for x in links])
            found = postings(np.frombuffer(b"".join(links), np.int64), doc)
            for at in range(0, len(found), 10_000):
                part = found.slice(at, 10_000)
                yield both(len(part), chunk, {c: part[c] for c in part.schema.names})
            ids = pa.concat_arrays([r[0] for r in rows])
            told = zip(*[r for x in rows for r in x[1]])
            named = dict(zip(("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups"), told))
            yield both(len(ids), chunk, {"number": range(len(ids)), "doc_id": ids} | named)

        for batch in batches:
            texts = batch["text"].to_pylist()
            for begin, stop in steps([len(t) for t in texts], STEP):
                found = aligner(texts[begin:stop])
                done = 0
                while done < len(found):  # a chunk may end within these texts
                    take = found[done : done + CHUNK - len(links)]
                    told = []
                    for parts in take:
                        whole = parts and None not in parts
                        link = b"".join([p[3] for p in parts]) if whole else b""
                        groups = ";".join([p[2] for p in parts]) if whole else ""
                        digest = hashlib.sha256(groups.encode()).hexdigest() if whole else ""
                        sums = (sum([p[0] for p in parts]), sum([p[1] for p in parts])) if whole else (0, 0)
                        told.append((*sums, len(link) // 8, len(link) // 8, digest, groups if with_groups else None))
                        links.append(link)
                        held += len(link) // 8
                    rows.append((batch["doc_id"].slice(begin + done, len(take)), told))
                    done += len(take)
                    if len(links) == CHUNK or held >= CHUNK_LINKS:
                        yield from close()
                        chunk, rows, links, held = chunk + 1, [], [], 0
        if rows:
            yield from close()

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = _ROWS.format(kind)
    kinds = {"doc_id": None, "chunk": pa.int64(), "number": pa.int32(), "groups_sha256": pa.string(), "groups": pa.string(), "plane": pa.int32(), "docs": pa.binary()}
    names = [c.split()[0] for c in schema.split(", ")]

    def both(n: int, chunk: int, columns: dict) -> pa.RecordBatch:
        columns = {"chunk": np.full(n, chunk)} | columns
        of = kinds | ({"doc_id": columns["doc_id"].type} if "doc_id" in columns else {"doc_id": doc_type})
        arrays = [
            (c if isinstance(c, pa.Array) else pa.array(c, of.get(x, pa.int64()))) if (c := columns.get(x)) is not None else pa.nulls(n, of.get(x, pa.int64()))
            for x in names
        ]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    from pyspark.sql.pandas.types import to_arrow_type

    doc_type = to_arrow_type(docs.schema["doc_id"].dataType)
    at = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return at.mapInArrow(run, schema)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, links, documents, best) of each id pair: best if no pair of its B id has more links."""
    of = rows.where("pair is not null").groupBy("pair").agg(
        F.sum(F.expr("shiftleft(n, plane)")).alias("links"), F.sum("fresh").alias("documents")
    )
    of = of.withColumn("b", F.expr(f"pair % {_HALF}"))
    most = of.groupBy("b").agg(F.max("links").alias("most"))
    return of.join(small(most), "b").select("pair", "links", "documents", (F.col("links") == F.col("most")).alias("best"))


def scores(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """(chunk, number, n_best, count_sum): each posting, with its pair's count, adds to the documents of its bitmap."""
    found = rows.where("pair is not null").select("chunk", "pair", "plane", "docs").join(small(counts.select("pair", "links", "best")), "pair")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, best, total = None, np.zeros(CHUNK, np.int64), np.zeros(CHUNK, np.int64)

        def close() -> pa.RecordBatch:
            at = np.flatnonzero(total)
            columns = [np.full(len(at), now), at.astype(np.int32), best[at], total[at]]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["chunk", "number", "n_best", "count_sum"])

        for batch in batches:
            chunk = batch["chunk"].to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]
            for begin, stop in zip(edges, edges[1:]):
                if begin == stop:
                    continue
                if chunk[begin] != now:
                    if now is not None:
                        yield close()
                    now, best, total = int(chunk[begin]), np.zeros(CHUNK, np.int64), np.zeros(CHUNK, np.int64)
                part = batch.slice(begin, stop - begin)
                number, of = unpack(part["docs"].to_pylist())
                times = np.int64(1) << part["plane"].to_numpy()[of].astype(np.int64)
                np.add.at(total, number, times * part["links"].to_numpy()[of])
                np.add.at(best, number, times * part["best"].to_numpy(zero_copy_only=False)[of])
        if now is not None:
            yield close()

    at = found.select("chunk", "plane", "docs", "links", "best").repartition("chunk").sortWithinPartitions("chunk")
    return at.mapInArrow(run, "chunk long, number int, n_best long, count_sum long")


def align(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = False) -> tuple[DataFrame, DataFrame]:
    """Two tables: (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, groups) of each row of docs and
    (a, b, links, documents, best) of each id pair that is linked anywhere.

    path_a is a byte-level file of tokenizers, path_b a sentencepiece model that puts a space before a text and keeps
    others as they are; strings of special tokens in a text are plain text. n_best counts links whose pair has the
    most links of all pairs of its B id, ties included; count_sum adds up the counts of a row's links. groups are
    like a1,a2|b1;a3|b2, in order (null unless asked for). A text that is null, empty or not given back by the bytes of
    either's tokens has no tokens: zeros and ''. Rows that repeat a doc_id, null or not, are rows of the result each;
    an empty table gives empty tables. Texts may be of any length; other columns are ignored."""
    rows = written(aligned(docs, path_a, path_b, with_groups), "aligned")
    counts = written(pair_counts(rows), "pairs")
    found = scores(rows, counts).select(F.col("chunk").alias("c"), F.col("number").alias("k"), "n_best", "count_sum")
    of = rows.where("number is not null")
    of = of.join(found, (F.col("chunk") == F.col("c")) & (F.col("number") == F.col("k")), "left")
    zero = F.lit(0).cast("long")
    out = of.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256", "groups",
    )
    return out, counts.select(F.expr(f"pair div {_HALF}").alias("a"), F.expr(f"pair % {_HALF}").alias("b"), "links", "documents", "best")
