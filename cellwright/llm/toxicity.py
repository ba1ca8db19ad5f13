"""Toxicity by gradient-boosted trees over dense features of whole texts, with isotonic calibration.

Features: densities of a fixed insult list and of stems that the labelled rows show to be toxic, how
near second-person words are to such hits, capitals, punctuation and obfuscation rates. Trees and
calibration are fitted with numpy on a bounded sample of labelled rows; feature extraction and
scoring run over Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens

#: Rows that the model is fitted on at most: those of the smallest hashes of their ids.
SAMPLE_ROWS = 20_000
#: Stems are word beginnings of that many bytes, or whole words (0).
STEMS = (0, 4, 5, 6, 7, 9)
NEAR = 5

# Fixed word lists.
INSULTS = """idiot idiots moron morons stupid dumb loser losers clown trash scum pathetic worthless disgusting
fool fools jerk imbecile retard ugly garbage filth vermin dummkopf idiotisch abschaum dumm
imbécile crétin ordure minable idiota estúpido estúpida basura imbécil asqueroso""".split()
THREATS = "kill die hurt destroy shut hate hates hated burn beat".split()
PERSONS = "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti usted ustedes vosotros".split()

#: Digits and signs that stand for letters.
_LEET = np.arange(256, dtype=np.uint8)
for _a, _b in zip(b"013457@$!", b"oieastasi", strict=True):
    _LEET[_a] = _b
_LEET_WORD = tokens.ALNUM | tokens.table(b"@$!")
_UPPER, _LETTER = tokens.table(bytes(range(65, 91))), tokens.table(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
_DIGIT, _PUNCT = tokens.table(b"0123456789"), tokens.table(bytes([*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))

FEATURES = ("insult", "threat", "stem", "hits", "person", "near_person", "near_share", "obfuscated", "mixed", "starred",
            "capitals", "shouted", "exclaimed", "asked", "punctuation", "repeated_sign", "digits", "log_words", "word_length")


def _sorted_hashes(words: list[str]) -> np.ndarray:
    return np.sort(np.array([tokens.hash_of(w.encode()) for w in words], np.uint64))


def _among(x: np.ndarray, sorted_values: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x


def _stem_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
    """For each kind of stem the hash of each word's; 0 for words that are no longer than it."""
    for k, size in enumerate(STEMS):
        if size:
            h = tokens.span_hashes(data, starts, np.minimum(starts + size, ends))
            yield np.where(ends - starts > size, tokens.mix(h ^ np.uint64(k)), np.uint64(0))
        else:
            yield tokens.mix(tokens.span_hashes(data, starts, ends))


def features(column: pa.Array, stems: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text of the column; a null text is an empty one, whose rates are 0.
    stems: the sorted hashes of toxic stems."""
    lists = [_sorted_hashes(x) for x in (INSULTS, THREATS, PERSONS)]
    out = np.zeros((len(column), len(FEATURES)))
    for row, end, raw, offs in tokens.chunks(column):
        n = end - row
        data = tokens.FOLD[raw]
        starts, ends, first = tokens.word_spans(data, offs, tokens.ALNUM)
        hashes = tokens.span_hashes(data, starts, ends)
        insult, threat, person = (_among(hashes, x) for x in lists)
        stem = np.zeros(len(starts), bool)
        for h in _stem_hashes(data, starts, ends):
            stem |= _among(h, stems)
        hit = insult | stem
        text = np.repeat(np.arange(n), np.diff(first))
        near = np.zeros(len(starts), bool)  # a second-person word of the same text close by
        for k in range(1, NEAR + 1):
            same = text[k:] == text[:-k]
            near[k:] |= person[:-k] & same
            near[:-k] |= person[k:] & same
        lt, le, lf = tokens.word_spans(data, offs, _LEET_WORD)
        plain = _among(tokens.span_hashes(_LEET[data], lt, le), lists[0])
        odd = plain & ~_among(tokens.span_hashes(data, lt, le), lists[0])
        digit = np.concatenate([[0], np.cumsum(_DIGIT[data])])
        letter = np.concatenate([[0], np.cumsum(_LETTER[data])])
        mixed = (digit[ends] > digit[starts]) & (letter[ends] > letter[starts])
        star = np.zeros(len(data), bool)
        if len(data) > 2:
            star[1:-1] = (data[1:-1] == 42) & _LETTER[data[:-2]] & _LETTER[data[2:]]
        twice = np.zeros(len(data), bool)
        twice[1:] = _PUNCT[data[1:]] & (data[1:] == data[:-1])
        up = np.concatenate([[0], np.cumsum(_UPPER[raw])])
        shouted = (up[ends] - up[starts] == ends - starts) & (ends - starts > 1)

        def per_word(x: np.ndarray, bounds: np.ndarray = first) -> np.ndarray:
            s = np.concatenate([[0], np.cumsum(x)])
            return s[bounds[1:]] - s[bounds[:-1]]  # noqa: B023

        size, words = np.diff(offs).astype(float), np.diff(first).astype(float)
        w, b = np.maximum(words, 1), np.maximum(size, 1)
        letters = per_word(_LETTER[data], offs)
        hits = per_word(hit)
        close = per_word(hit & near)
        out[row:end] = np.stack([
            per_word(insult) / w, per_word(threat) / w, per_word(stem) / w, np.log1p(hits), per_word(person) / w,
            close / w, close / np.maximum(hits, 1), per_word(odd, lf) / w, per_word(mixed) / w, per_word(star, offs) / w,
            per_word(_UPPER[raw], offs) / np.maximum(letters, 1), per_word(shouted) / w, per_word(data == 33, offs) / b, per_word(data == 63, offs) / b,
            per_word(_PUNCT[data], offs) / b, per_word(twice, offs) / b, per_word(_DIGIT[data], offs) / b, np.log1p(words), letters / w,
        ], axis=1)
    return out


@dataclass
class Trees:
    """Boosted trees of equal depth over features cut into bins, and a calibration curve."""

    edges: list
    base: float
    feature: np.ndarray  # (trees, inner nodes)
    cut: np.ndarray
    leaf: np.ndarray
    depth: int
    curve_x: np.ndarray
    curve_y: np.ndarray

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "left") for k, e in enumerate(self.edges)], axis=1).astype(np.int16)

    def raw(self, bins: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(bins), self.base), np.arange(len(bins))
        for f, c, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(bins), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (bins[rows, f[node]] > c[node])
            out += leaf[node - len(f)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        raw = self.raw(self.bins(x))
        return np.clip(np.interp(raw, self.curve_x, self.curve_y), 0.0, 1.0)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points of the rising curve of least squares through (x, y): the middle of each pooled block."""
    order = np.argsort(x, kind="stable")
    values, at = np.unique(x[order], return_inverse=True)
    weight = np.bincount(at).astype(float)
    blocks: list[list[float]] = []
    for v, w, s in zip(values, weight, np.bincount(at, y[order]), strict=True):
        blocks.append([s, w, v * w])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    return np.array([b[2] / b[1] for b in blocks]), np.array([b[0] / b[1] for b in blocks])


def boost(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 32, floor: float = 1.0) -> Trees:
    """Trees for the 0/1 values y. Every fourth row, by place, is kept for the calibration curve."""
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        none = np.zeros((0, 2**depth - 1), np.int64)
        return Trees([np.zeros(0)] * x.shape[1], 0.0, none, none, np.zeros((0, 2**depth)), depth, np.array([0.0]), np.array([share]))
    held = np.arange(len(y)) % 4 == 3
    if y[held].min() == y[held].max() or y[~held].min() == y[~held].max():
        held = np.zeros(len(y), bool)
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins)[1:-1])) for k in range(x.shape[1])]
    # rates that are nearly always 0 still get a cut there
    edges = [np.unique(np.concatenate([[0.0], e, np.quantile(c[c > 0], [0.25, 0.5, 0.75])])) if (c := x[:, k]).max() > 0 else e for k, e in enumerate(edges)]
    wide = max(map(len, edges)) + 1
    share = y[~held].mean()
    model = Trees(edges, float(np.log(share / (1 - share))), *(np.zeros((trees, 2**depth - 1), np.int64) for _ in range(2)), np.zeros((trees, 2**depth)), depth, np.zeros(0), np.zeros(0))
    b, t = model.bins(x[~held]).astype(np.int64), y[~held]
    raw, count = np.full(len(t), model.base), b.shape[1]
    flat = b + np.arange(count) * wide
    for k in range(trees):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = t - p, p * (1 - p)
        node = np.zeros(len(t), np.int64)
        for level in range(depth):
            low, n = 2**level - 1, 2**level
            key = ((node - low)[:, None] * (count * wide) + flat).ravel()
            sums = [np.bincount(key, np.repeat(v, count), n * count * wide).reshape(n, count, wide).cumsum(2) for v in (grad, hess)]
            g, h = sums
            total_g, total_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + floor) + (total_g - g) ** 2 / (total_h - h + floor)
            best = gain.reshape(n, -1).argmax(1)
            model.feature[k, low : low + n], model.cut[k, low : low + n] = best // wide, best % wide
            node = 2 * node + 1 + (b[np.arange(len(t)), model.feature[k][node]] > model.cut[k][node])
        place = node - (2**depth - 1)
        model.leaf[k] = rate * np.bincount(place, grad, 2**depth) / (np.bincount(place, hess, 2**depth) + floor)
        raw += model.leaf[k][place]
    use = held if held.any() else np.ones(len(y), bool)
    # one row of either label beyond the ends keeps scores off 0 and 1 where there are few rows
    at = model.raw(model.bins(x[use]))
    model.curve_x, model.curve_y = isotonic(np.concatenate([at, [at.max(), at.min()]]), np.concatenate([y[use], [0.0, 1.0]]))
    return model


@dataclass
class Model:
    stems: np.ndarray
    trees: Trees


def _toxic_stems(sample: DataFrame) -> np.ndarray:
    """Hashes of the stems of which toxic texts have significantly more than their share: those of the
    bounded sample only, and each in several texts, so the sample bounds how many there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            found = []
            for row, _, data, offs in tokens.chunks(batch.column(0)):
                data = tokens.FOLD[data]
                starts, ends, first = tokens.word_spans(data, offs, tokens.ALNUM)
                text = np.repeat(np.arange(len(offs) - 1), np.diff(first))
                for h in _stem_hashes(data, starts, ends):
                    pair = np.unique(np.stack([h, text.astype(np.uint64)], 1)[h != 0], axis=0)
                    found.append(np.stack([pair[:, 0], label[row + pair[:, 1].astype(np.int64)].astype(np.uint64)], 1))
            rows = np.concatenate(found) if found else np.zeros((0, 2), np.uint64)
            stem, at = np.unique(rows[:, 0], return_inverse=True)
            toxic = np.bincount(at, rows[:, 1].astype(float), len(stem)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(stem.view(np.int64)), pa.array(np.bincount(at, minlength=len(stem))), pa.array(toxic)], ["stem", "n", "t"])

    share = sample.agg(F.avg("label")).first()[0] or 0.0
    if not 0 < share < 1:
        return np.zeros(0, np.uint64)
    seen = sample.select("text", "label").mapInArrow(run, "stem long, n long, t long").groupBy("stem").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    z = (F.col("t") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share))
    best = seen.where((z >= 7) & (F.col("t") >= 0.9 * F.col("n"))).select("stem")
    return np.sort(np.array([r["stem"] for r in best.collect()], np.int64).view(np.uint64))


def _rows(texts: DataFrame, stems: np.ndarray, ids: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch.column(1), stems)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], [ids, "x"])

    return texts.mapInArrow(run, f"{ids} long, x array<double>")


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on documents that labels (doc_id, toxic) names with toxic 0 or 1; other labels count as
    none, and of several for one document the larger holds. At most sample_rows labels and as many texts are used,
    those of the smallest hashes; equal texts count once, with the label of their smallest id, however many rows have them, and
    different texts of one id each have its label. Without labels of both kinds every score is the share of label 1, 0 if there is none."""
    named = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("long").alias("label"))
    named = F.broadcast(named.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    digest = F.md5(F.coalesce("text", F.lit("")))
    rows = docs.select(F.col("doc_id").alias("id"), "text", digest.alias("digest")).join(named.withColumnRenamed("doc_id", "id"), "id")
    once = rows.groupBy("digest").agg(F.min(F.struct("id", "label")).alias("of"))
    once = once.select("digest", "of.*").orderBy(F.xxhash64("id"), "id", "digest").limit(sample_rows)
    sample = rows.join(F.broadcast(once.select("digest", "id")), ["digest", "id"], "left_semi")
    sample = sample.groupBy("digest").agg(F.min("text").alias("text"), F.max("label").alias("label")).drop("digest")
    stems = _toxic_stems(sample)
    rows = _rows(sample.select("label", "text"), stems, "label").toPandas()
    x = np.array(rows["x"].tolist(), float).reshape(-1, len(FEATURES))
    order = np.lexsort([*x.T, rows["label"].to_numpy()]) if len(x) else np.zeros(0, int)
    order = order[np.random.default_rng(0).permutation(len(order))]  # the same whatever order rows came in
    return Model(stems, boost(x[order], rows["label"].to_numpy(float)[order]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for every row of docs: higher where toxicity is likelier, 0 to 1. A null or
    empty text has features of 0. Repeated rows stay repeated; other columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(m.trees.score(features(batch.column(1), m.stems)))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def drop_toxic(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of docs that score below least, with their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place, schema = docs.columns.index("text"), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            yield batch.filter(pa.array(m.trees.score(features(batch.column(place), m.stems)) < least))

    return docs.mapInArrow(run, schema)
