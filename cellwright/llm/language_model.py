"""Language-model scoring with a weighted backoff automaton.

Every word, and every pair and run of three that the training texts hold at least MIN_COUNT times, is
part of the model: an absolute count, the same at every size, so that the model grows with the corpus
and is nowhere whole. Counts are smoothed by interpolated absolute discounting:

    P(w | h) = (c(hw) - off) / c(h) + left(h) P(w | h without its oldest word)   if hw is in the model
    P(w | h) =                        left(h) P(w | h without its oldest word)   otherwise

left(h) being what the discounts have left of h's probability; what all unseen words share is one outcome.

Texts are packed in chunks. A chunk asks for the counts of its distinct n-grams: its sorted hashes are
cut into ranges, and what all chunks ask of a range meets there, one entry for each chunk however
often an n-gram occurs in it, so that frequent ones are counted before they are shuffled. The range adds
up and answers each chunk with the n-grams that are in the model; the first chunk that has such an
n-gram adds it to what its history has kept. Runs are counted first, then pairs with what runs tell
of them as histories, then words. From the answers a chunk builds the part of the automaton that its texts
reach and reads them in one traversal from left to right.

States are n-gram histories. An arc reads a word, adds its log-probability and leads to the longest
history that is a state; if a state has no arc for a word, its failure arc adds log10(left) and
leads to the state without the oldest word.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import released, written

#: Cannot be a word, as it is white space.
END = " "
_BEGIN = -2
_LANE = 128
#: How often an n-gram of several words has to occur to be an arc.
MIN_COUNT = 2
#: Bytes of text of a chunk (a longer text is one of its own), of text whose n-grams meet in a range, and
#: the ranges at least.
CHUNK, RANGE, RANGES = 2 << 20, 6 << 20, 64


@dataclass
class Automaton:
    """fail, back: of each state its failure arc and that arc's weight; state 0 is the root, state
    1 + i has read word i alone. keys, goto, logp: the arcs, sorted by state * words + word."""

    end: int
    logp1: np.ndarray
    fail: np.ndarray
    back: np.ndarray
    keys: np.ndarray
    goto: np.ndarray
    logp: np.ndarray

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Read one word in each lane: the next states and the log-probabilities."""
        out, to = np.zeros(len(state)), np.zeros(len(state), np.int64)
        begin = word == _BEGIN
        to[begin] = self.end + 1
        live = np.flatnonzero(~begin)
        now, read = state[live], word[live]
        while len(live):
            found = np.zeros(len(live), bool)
            if len(self.keys):
                key = now * len(self.logp1) + read
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                found = (self.keys[at] == key) & (now > 0)
                to[live[found]] = self.goto[at[found]]
                out[live[found]] += self.logp[at[found]]
            root = ~found & (now == 0)
            to[live[root]] = read[root] + 1
            out[live[root]] += self.logp1[read[root]]
            on = ~found & ~root
            out[live[on]] += self.back[now[on]]
            live, now, read = live[on], self.fail[now[on]], read[on]
        return to, out

    def read(self, word: np.ndarray) -> np.ndarray:
        """Log-probabilities of a run of words, read from left to right in lanes side by side. A lane
        first reads the two words before it, after which its state is that of an unbroken traversal."""
        lanes = -(-len(word) // _LANE)
        padded = np.full(2 + lanes * _LANE, _BEGIN)
        padded[2 : 2 + len(word)] = word
        at = np.arange(lanes) * _LANE
        state, out = np.zeros(lanes, np.int64), np.zeros((lanes, _LANE))
        for k in range(2 + _LANE):
            state, logp = self.step(state, padded[at + k])
            if k >= 2:
                out[:, k - 2] = logp
        return out.reshape(-1)[: len(word)]


def _left(c: np.ndarray, kept: np.ndarray, arcs: np.ndarray, off: float) -> np.ndarray:
    """What is left of each history's probability by the arcs after it, kept being their counts in all."""
    return np.where(arcs > 0, 1.0 - (kept - off * arcs) / np.maximum(c, 1), 1.0)


def automaton(end: int, words: tuple, pairs: tuple, runs: tuple, n: int, v: int, off: float) -> Automaton:
    """words: c, kept, arcs of each word; pairs: those of each arc of a word's state, and the word and the
    next one; runs: c of each arc of a pair's state, the numbers of its history and of its last two words as pairs,
    and the next word. kept and arcs are the counts in all and the number of the arcs after a history."""
    c1, kept1, arcs1 = words
    c2, kept2, arcs2, first, second = pairs
    c3, history, low, third = runs
    size = len(c1)
    p1 = np.where(c1 > 0, (c1 - off) / n, off * v / n) if n else np.ones(size)
    left1, left2 = _left(c1, kept1, arcs1, off), _left(c2, kept2, arcs2, off)
    p2 = (c2 - off) / c1[first] + left1[first] * p1[second]
    p3 = (c3 - off) / c2[history] + left2[history] * p2[low]
    keys = np.concatenate([(1 + first) * size + second, (1 + size + history) * size + third]).astype(np.int64)
    goto = np.concatenate([1 + size + np.arange(len(c2)), 1 + size + low]).astype(np.int64)
    by = np.argsort(keys, kind="stable")
    fail = np.concatenate([np.zeros(1 + size), 1 + second]).astype(np.int64)
    back = np.log10(np.concatenate([[1.0], left1, left2]))
    return Automaton(end, np.log10(p1), fail, back, keys[by], goto[by], np.log10(np.concatenate([p2, p3]))[by])


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of a history's hash and the word read after it."""
    return tokens.mix(a * np.uint64(0xD6E8FEB86659FD93) + b)


@dataclass
class Grams:
    """The words of a chunk, with a place that is not read before each text and END after. By place:
    word, two, three, the hashes of the word, of the last two and of the last three; read and long, where the
    last one and the last three lie within a text. begin is where texts begin."""

    begin: np.ndarray
    text: np.ndarray
    word: np.ndarray
    two: np.ndarray
    three: np.ndarray
    read: np.ndarray
    long: np.ndarray


def grams(data: np.ndarray, offs: np.ndarray) -> Grams:
    end = np.uint64(tokens.hash_of(END.encode()))
    data = tokens.FOLD[data]
    starts, ends, first = tokens.word_spans(data, offs, tokens.NOT_SPACE)
    count = len(first) - 1
    begin = first[:-1] + 2 * np.arange(count)
    word = np.full(len(starts) + 2 * count, end, np.uint64)
    word[np.arange(len(starts)) + 1 + 2 * (np.searchsorted(first, np.arange(len(starts)), "right") - 1)] = tokens.span_hashes(data, starts, ends)
    text = np.repeat(np.arange(count), np.diff(np.append(begin, len(word))))
    two, three = np.zeros_like(word), np.zeros_like(word)
    two[1:] = _pair(word[:-1], word[1:])
    three[1:] = _pair(two[:-1], word[1:])
    read = np.ones(len(word), bool)
    read[begin] = False
    long = read.copy()
    long[1:] &= read[:-1]
    return Grams(begin, text, word, two, three, read, long)


def chunks(docs: DataFrame, learn: Column, size: int = CHUNK) -> DataFrame:
    """(chunk, bytes, ids, learns, ends, data): docs (doc_id, text) packed in rows of about that many bytes of text,
    which are compressed as they are shuffled more than once; ends says where each text ends in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(2).cast(pa.string()).fill_null("")
            for row, end, data, offs in tokens.chunks(text, size):
                one = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
                part = [one(pa.concat_arrays([c.slice(row, end - row)])) for c in (batch.column(0), batch.column(1))]
                packed = pa.array([pa.compress(np.ascontiguousarray(data), codec="zstd", asbytes=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().int >> 65]), pa.array([len(data)], pa.int64()), *part, one(pa.array(offs[1:])), packed], ["chunk", "bytes", "ids", "learns", "ends", "data"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(learn, F.lit(False)).alias("learn"), "text")
    return rows.mapInArrow(run, "chunk long, bytes long, ids array<long>, learns array<boolean>, ends array<long>, data binary")


def _pack(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte: the first bytes of all, then the second ones; of most of these all are alike."""
    return np.ascontiguousarray(numbers.astype(">u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(">u8").ravel().astype(np.uint64)


def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


_ASKS = "part long, chunk long, keys binary, c binary, kept binary, arcs binary"
_ANSWERS = "part long, chunk long, level int, at binary, c binary, kept binary, arcs binary, facts array<long>"


def _asks(chunk: int, keys: np.ndarray, c: np.ndarray, ranges: int, kept: np.ndarray | None = None, arcs: np.ndarray | None = None) -> pa.Table:
    """A row for each range that the sorted keys of a chunk fall in."""
    cuts = np.flatnonzero(np.diff(_range_of(keys, ranges).astype(np.int64), prepend=-1))
    spans = list(zip(cuts, np.append(cuts[1:], len(keys)), strict=True)) if len(keys) else []
    columns = {
        "part": pa.array(_range_of(keys[cuts], ranges).astype(np.int64)), "chunk": pa.array([chunk] * len(spans), pa.int64()),
        "keys": pa.array([_pack(keys[a:b]) for a, b in spans], pa.binary()),
    }
    for name, x in (("c", c), ("kept", kept), ("arcs", arcs)):
        columns[name] = pa.array([None if x is None else _pack(x[a:b]) for a, b in spans], pa.binary())
    return pa.table(columns)


def _distinct(keys: np.ndarray, of: np.ndarray, learns: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None, np.ndarray, np.ndarray]:
    """The distinct keys at the places of, how often each occurs in what is learnt, the place of one
    occurrence, and by place the number of its key."""
    places = np.flatnonzero(of)
    places = places[np.argsort(keys[places])]
    new = np.ones(len(places), bool)
    new[1:] = keys[places[1:]] != keys[places[:-1]]
    starts, number = np.flatnonzero(new), np.full(len(keys), -1)
    number[places] = np.cumsum(new) - 1
    c = None if learns is None else np.bincount(number[places], learns[places], len(starts))
    return keys[places[starts]], c, places[starts], number


def _met(level: int):
    """The function that answers what chunks ask of a range of n-grams of so many words."""
    least = MIN_COUNT if level > 1 else 1

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([_unpack(k) for k in pdf["keys"]])
        stops = np.cumsum([len(k) // 8 for k in pdf["keys"]])
        order = np.argsort(keys)
        new = np.ones(len(keys), bool)
        new[1:] = keys[order][1:] != keys[order][:-1]
        starts, which = np.flatnonzero(new), np.empty(len(keys), np.int64)
        which[order] = np.cumsum(new) - 1
        add = lambda parts: np.add.reduceat(np.concatenate([_unpack(x) for x in parts]).view(np.int64)[order], starts)
        c = add(pdf["c"])
        kept, arcs = (add(pdf[k]) if level < 3 else None for k in ("kept", "arcs"))
        own = np.zeros(len(keys), bool)
        own[order[starts]] = True
        hit, rows = c >= least, []
        if level == 1:
            rows.append((pdf["part"].iloc[0], -1, level, None, None, None, None, [int(c.sum()), int(hit.sum()), int((c == 1).sum()), int((c == 2).sum())]))
        for chunk, a, b in zip(pdf["chunk"], np.append(0, stops[:-1]), stops, strict=True):
            at = np.flatnonzero(hit[which[a:b]])
            if len(at):
                g = which[a:b][at]
                name = 2 * np.diff(at, prepend=0) + own[a:b][at]
                rows.append((pdf["part"].iloc[0], chunk, level, *(None if x is None else _pack(x) for x in (name, c[g], *(None if x is None else x[g] for x in (kept, arcs)))), None))
        return pd.DataFrame(rows, columns=["part", "chunk", "level", "at", "c", "kept", "arcs", "facts"])

    return run


def _answers(table: pa.Table, level: int, keys: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each of a chunk's sorted keys what ranges say: c, kept, arcs and whether the chunk owns it."""
    c, kept, arcs = (np.zeros(len(keys), np.int64) for _ in range(3))
    own = np.zeros(len(keys), bool)
    base = np.searchsorted(_range_of(keys, ranges), np.arange(ranges, dtype=np.uint64))
    for row in table.to_pylist():
        if row["level"] == level:
            name = _unpack(row["at"]).view(np.int64)
            at = base[row["part"]] + np.cumsum(name // 2)
            own[at] = name % 2 > 0
            for x, k in ((c, "c"), (kept, "kept"), (arcs, "arcs")):
                if row[k] is not None:
                    x[at] = _unpack(row[k]).view(np.int64)
    return c, kept, arcs, own


def _rows_of(table: pa.Table) -> Iterator[tuple[int, pa.Array, pa.Array, Grams]]:
    """Of each row of a table of chunks: its name, ids, learns, and the words of its texts."""
    for k in range(table.num_rows):
        ends = table["ends"][k].values.to_numpy()
        data = pa.decompress(table["data"][k].as_py(), decompressed_size=int(ends[-1]), codec="zstd") if ends[-1] else b""
        yield table["chunk"][k].as_py(), table["ids"][k].values, table["learns"][k].values, grams(np.frombuffer(data, np.uint8), np.append(0, ends))


def _learnt(g: Grams, learns: pa.Array) -> np.ndarray:
    return np.asarray(learns.to_numpy(zero_copy_only=False), bool)[g.text]


def answers(packed: DataFrame, ranges: int) -> DataFrame:
    """What every chunk is told of its n-grams, and facts, of which the sums are the words in all, the
    distinct ones, and those that occur once and twice."""
    spark = packed.sparkSession

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, _, learns, g in _rows_of(pa.Table.from_batches([batch])):
                one, c, *_ = _distinct(g.three, g.long, _learnt(g, learns))
                yield from _asks(chunk, one, c, ranges).to_batches()

    def pairs(packed: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        for chunk, _, learns, g in _rows_of(packed):
            one, c, _, number = _distinct(g.two, g.read, _learnt(g, learns))
            three, _, at, _ = _distinct(g.three, g.long)
            c3, _, _, own = _answers(told, 3, three, ranges)
            history = number[at[own] - 1]
            kept, arcs = np.bincount(history, c3[own], len(one)), np.bincount(history, minlength=len(one))
            out.append(_asks(chunk, one, c, ranges, kept, arcs))
        return pa.concat_tables(out)

    def words(packed: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        for chunk, _, learns, g in _rows_of(packed):
            one, c, _, number = _distinct(g.word, g.read, _learnt(g, learns))
            two, _, at, _ = _distinct(g.two, g.read)
            c2, _, _, own = _answers(told, 2, two, ranges)
            # a place that is not read is the END before a text
            history = np.searchsorted(one, g.word[at[own] - 1])
            kept, arcs = np.bincount(history, c2[own], len(one)), np.bincount(history, minlength=len(one))
            out.append(_asks(chunk, one, c, ranges, kept, arcs))
        return pa.concat_tables(out)

    def meet(asks: DataFrame, level: int) -> DataFrame:
        out = written(asks.groupBy("part").applyInPandas(_met(level), _ANSWERS), f"level{level}")
        released(spark)
        return out

    def tell(f, told: DataFrame) -> DataFrame:
        return packed.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(f, _ASKS)

    three = meet(packed.mapInArrow(runs, _ASKS), 3)
    two = meet(tell(pairs, three), 2)
    one = meet(tell(words, two), 1)
    return three.union(two).union(one)


def score(packed: DataFrame, told: DataFrame, ranges: int) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of each text of the chunks."""
    row = told.where("chunk = -1").agg(*[F.sum(F.get("facts", F.lit(k))) for k in range(4)]).first()
    n, v, one, two = (int(x or 0) for x in row)
    off = min(0.9, max(0.1, one / (one + 2 * two))) if one + two else 0.5
    floor = float(np.log10(n + v + 1))

    def run(packed: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        for _, ids, _, g in _rows_of(packed):
            w, _, _, _ = _distinct(g.word, g.read)
            number1 = np.searchsorted(w, g.word)  # END of the begin places too
            k2, _, at2, number2 = _distinct(g.two, g.read)
            k3, _, at3, _ = _distinct(g.three, g.long)
            c1, kept1, arcs1, _ = _answers(told, 1, w, ranges)
            c2, kept2, arcs2, _ = _answers(told, 2, k2, ranges)
            c3, *_ = _answers(told, 3, k3, ranges)
            arc2, arc3 = np.flatnonzero(c2), np.flatnonzero(c3)
            new2 = np.cumsum(c2 > 0) - 1
            at2, at3 = at2[arc2], at3[arc3]
            m = automaton(
                int(np.searchsorted(w, np.uint64(tokens.hash_of(END.encode())))), (c1, kept1, arcs1),
                (c2[arc2], kept2[arc2], arcs2[arc2], number1[at2 - 1], number1[at2]),
                (c3[arc3], new2[number2[at3 - 1]], new2[number2[at3]], number1[at3]), n, v, off,
            )
            logp = m.read(np.where(g.read, number1, _BEGIN))
            known = g.read & (c1[number1] > 0)
            base = np.where(g.read, np.log10(c1[number1] + 1.0) - floor, 0.0)
            total = lambda x: np.add.reduceat(x, g.begin)
            out.append(pa.table([
                pa.concat_arrays([ids]), pa.array(total(g.read.astype(np.int64))), pa.array(total(known.astype(np.int64))), pa.array(np.full(len(ids), n)),
                pa.array(total(base)), pa.array(total(np.where(g.read, logp, 0.0))),
            ], names=_COLUMNS))
        return pa.concat_tables(out) if out else _NOTHING

    kinds = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    told = told.where("chunk <> -1")
    return packed.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(run, kinds)


_COLUMNS = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
_NOTHING = pa.table({name: pa.array([], pa.float64() if "score" in name else pa.int64()) for name in _COLUMNS})


def fit_and_score(docs: DataFrame, learn: Column, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for every row of docs (doc_id, text), by a
    model of those that the condition learn holds for.

    base_score adds up log10((c + 1) / (N + V + 1)) of the tokens, c being the training count; score is
    the automaton's log10 probability of the text and its end; n_known counts the tokens with c > 0.
    A null or empty text has its end as only token. Repeated rows stay repeated; other columns are
    ignored; without training texts every score is 0 (one outcome, certain); an empty table gives an empty one."""
    packed = written(chunks(docs, learn, chunk), "chunks")
    size = int(packed.agg(F.sum("bytes")).first()[0] or 0)
    ranges = max(RANGES, -(-size // RANGE))
    return score(packed, answers(packed, ranges), ranges)
