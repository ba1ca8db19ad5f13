"""Language identification by a byte convolutional network.

Bytes are embedded, filters of several widths run over fixed-length windows, each filter's largest
value in a window goes to a softmax layer. Training is plain numpy on windows of a bounded sample of
labelled texts; prediction covers whole texts, window by window, over Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tokens

WINDOW, WIDTHS, EMBED, FILTERS = 256, (2, 3, 4), 8, 16
#: Labelled texts that the network is fitted on at most, and windows of each.
SAMPLE_ROWS, WINDOWS_EACH = 3_000, 3
UNKNOWN = "und"


def windows(data: np.ndarray, offs: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every text cut into windows of size bytes, the last filled with zeros; which text each window
    is of, and how many bytes of it the window holds."""
    length = np.diff(offs)
    count = -(-length // size)
    text = np.repeat(np.arange(len(length)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = offs[:-1][text] + nth * size
    held = np.minimum(size, offs[1:][text] - start)
    at = start[:, None] + np.arange(size)
    out = data[np.minimum(at, max(len(data) - 1, 0))] if len(data) else np.zeros(at.shape, np.uint8)
    out[np.arange(size) >= held[:, None]] = 0
    return out, text, held


@dataclass
class Network:
    languages: list
    embed: np.ndarray  # (256, EMBED)
    kernels: list  # for each width (width, EMBED, FILTERS)
    dense: np.ndarray
    bias: np.ndarray

    def tables(self) -> list[list[np.ndarray]]:
        """Convolution as sums of lookups: for each width, of pairs of bytes and of a last odd byte."""
        out = []
        for kernel in self.kernels:
            parts = [(self.embed @ k).astype(np.float32) for k in kernel]
            pairs = [(parts[i][:, None] + parts[i + 1][None]).reshape(65536, -1) for i in range(0, len(parts) - 1, 2)]
            out.append(pairs + ([parts[-1]] if len(parts) % 2 else []))
        return out

    def logits(self, x: np.ndarray, tables: list) -> np.ndarray:
        pair = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        pooled = []
        for kernel, parts in zip(self.kernels, tables, strict=True):
            n = x.shape[1] - len(kernel) + 1
            total = None
            for k, part in enumerate(parts):
                one = part[(pair if len(part) == 65536 else x)[:, 2 * k : 2 * k + n]]
                total = one if total is None else np.add(total, one, out=total)
            pooled.append(total.max(1))
        return np.maximum(np.concatenate(pooled, 1), 0) @ self.dense + self.bias


def train(x: np.ndarray, y: np.ndarray, languages: list, epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 7) -> Network:
    """Adam on windows x and language numbers y. Only the place of each filter's largest value gets a
    gradient, so a step costs little more than its forward pass."""
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 0.5, (256, EMBED))]
    params += [rng.normal(0, 1 / np.sqrt(w * EMBED), (w, EMBED, FILTERS)) for w in WIDTHS]
    params += [rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))), np.zeros(len(languages))]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            xb, yb = x[order[at : at + batch]].astype(np.int64), y[order[at : at + batch]]
            rows = np.arange(len(xb))
            embed, *kernels = params[: 1 + len(WIDTHS)]
            dense, bias = params[-2:]
            pooled, places = [], []
            for kernel in kernels:
                n = xb.shape[1] - len(kernel) + 1
                total = sum((embed @ k)[xb[:, i : i + n]] for i, k in enumerate(kernel))
                places.append(total.argmax(1))
                pooled.append(np.take_along_axis(total, places[-1][:, None], 1)[:, 0])
            z = np.concatenate(pooled, 1)
            hidden = np.maximum(z, 0)
            logit = hidden @ dense + bias
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[rows, yb] -= 1
            p /= len(xb)
            grads = [np.zeros_like(embed), *[np.zeros_like(k) for k in kernels], hidden.T @ p, p.sum(0)]
            back = (p @ dense.T) * (z > 0)
            for j, (kernel, place) in enumerate(zip(kernels, places, strict=True)):
                g = back[:, j * FILTERS : (j + 1) * FILTERS]  # (batch, filters)
                for i in range(len(kernel)):
                    byte = xb[rows[:, None], place + i]
                    grads[1 + j][i] = np.einsum("bfe,bf->ef", embed[byte], g)
                    np.add.at(grads[0], byte, g[:, :, None] * kernel[i].T[None])
            step += 1
            for q, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Network(languages, params[0], params[1:-2], params[-2], params[-1])


def fit(docs: DataFrame, learn: Column, sample_rows: int = SAMPLE_ROWS) -> Network | None:
    """A network of the languages that rows with learn, a lang and a letter in text have; None if
    there is none. At most sample_rows of these rows are used, those of the smallest hashes of doc_id and text, null
    ids included; equal rows count once, and a text with two languages is a row of each."""
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.select(F.col("lang").cast("string").alias("l"), F.xxhash64("doc_id", "text").alias("h"), "text")
    chosen = F.broadcast(rows.select("h", "l").distinct().orderBy("h", "l").limit(sample_rows))
    # of each text a few windows at hashed places, cut by the executors; short texts give one
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, out = [], []
            for row, _, data, offs in tokens.chunks(batch.column(2)):
                x, text, held = windows(data, offs)
                rank = tokens.mix(np.arange(len(x)).astype(np.uint64) ^ batch.column(1).to_numpy()[row + text].view(np.uint64))
                order = np.lexsort((rank, text))
                first = np.searchsorted(text[order], np.arange(len(offs)))
                nth = np.arange(len(x)) - first[text[order]]
                keep = order[nth < WINDOWS_EACH]
                lang += batch.column(0).take(pa.array(row + text[keep])).to_pylist()
                out += [w.tobytes() for w in x[keep]]
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(out, pa.binary())], ["lang", "window"])

    sample = rows.join(chosen, ["h", "l"], "left_semi").dropDuplicates(["h", "l"])
    got = sample.select("l", "h", "text").mapInArrow(run, "lang string, window binary").toPandas()
    if not len(got):
        return None
    got = got.sort_values(["window", "lang"])
    languages = sorted(set(got["lang"]))
    x = np.frombuffer(b"".join(bytes(w) for w in got["window"]), np.uint8).reshape(-1, WINDOW)
    return train(x, np.searchsorted(np.array(languages), got["lang"].to_numpy()), languages)


def predict(docs: DataFrame, network: Network | None) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of docs: the language of the largest mean probability
    over all windows, weighted by their bytes, and that probability. A text that is null or has no
    letters is "und" with score 0, and so is every text if there is no network. Repeated rows stay
    repeated; other columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        tables = net.tables() if net else None
        for batch in batches:
            best, score = [], []
            if net:
                for _, _, data, offs in tokens.chunks(batch.column(2)):
                    x, text, held = windows(data, offs)
                    sums = np.zeros((len(offs) - 1, len(net.languages)))
                    for at in range(0, len(x), 128):
                        z = net.logits(x[at : at + 128], tables)
                        p = np.exp(z - z.max(1, keepdims=True))
                        np.add.at(sums, text[at : at + 128], p / p.sum(1, keepdims=True) * held[at : at + 128, None])
                    p = sums / np.maximum(np.diff(offs), 1)[:, None]
                    best += [net.languages[k] for k in p.argmax(1)]
                    score += p.max(1).tolist()
            else:
                best, score = [UNKNOWN] * len(batch), [0.0] * len(batch)
            letters = batch.column(1).to_pylist()
            best = [b if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)]
            score = [s if ok else 0.0 for s, ok in zip(score, letters, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.string()), pa.array(np.minimum(score, 1.0))], ["doc_id", "lang_pred", "score"])

    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), letter.alias("letter"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
