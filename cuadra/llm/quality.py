"""Quality of a text by a byte-level convolutional network.

The bytes of a text are cut into overlapping chunks that cover all of it. A byte enters the network as
a learned vector and, since no filter can compare bytes with each other, two echo channels: whether the
last four bytes stood already in the 64 or the 1,024 bytes before. Filters over whole chunks give each
chunk its activations, the largest and the mean of each filter over the text are kept, and a logistic
layer combines them into one probability. Everything is numpy; training goes through the chunk that won
the maximum and through the mean.

Fitting works on a bounded sample of labelled rows outside the held-out fold: at most ``sample`` of
each class, of at most ``max_bytes`` each, the same rows on every run. Scoring reads every byte of every
text inside the tasks that read them, without a shuffle, a few hundred chunks at a time.

Cases: null text counts as empty. A short text is one chunk filled up with zero bytes; an empty text is
one chunk of zero bytes. Repeated rows are all scored. Without usable labels, or with one class only,
every text gets the share of good labels. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuadra.llm.common import held_out, query, table
from cuadra.llm.toxicity import labelled_sample

SAMPLE = 1000  # labelled documents of each class
MAX_BYTES = 16_384  # longer documents are not learned from
CHUNK, STRIDE = 64, 32
CHANNELS, FILTERS = 6, 16
STEPS, BATCH, RATE = 300, 48, 0.01
KEEP = 0.3
_ECHOES = (64, 1024)
_SLAB = 1 << 16  # bytes that are held as numbers at once


def echoes(data: np.ndarray) -> np.ndarray:
    """For each byte and each reach: 1 if the four bytes up to it stood within that many bytes before."""
    n = len(data)
    out = np.zeros((n, len(_ECHOES)), np.float32)
    if n > 4:
        wide = data.astype(np.uint32)
        four = wide[:-3] | wide[1:-2] << 8 | wide[2:-1] << 16 | wide[3:] << 24
        order = np.argsort(four, kind="stable")
        same = four[order[1:]] == four[order[:-1]]
        gap = order[1:] - order[:-1]
        for k, reach in enumerate(_ECHOES):
            out[order[1:][same & (gap <= reach)] + 3, k] = 1
    return out


class ByteNetwork:
    """Byte vectors, filters and the logistic layer."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        width = CHANNELS + len(_ECHOES)
        self.p = {
            "bytes": r.normal(0, 0.5, (256, CHANNELS)).astype(np.float32),
            "filters": r.normal(0, 1 / math.sqrt(CHUNK * width), (CHUNK * width, FILTERS)).astype(np.float32),
            "bias": np.zeros(FILTERS, np.float32),
            "out": r.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
            "base": np.zeros(1, np.float32),
        }

    def chunks(self, data: np.ndarray, echo: np.ndarray) -> np.ndarray:
        """(chunks, values): the input of each chunk."""
        rows = np.arange(0, max(len(data) - CHUNK, 0) + STRIDE, STRIDE)
        need = int(rows[-1]) + CHUNK
        if need > len(data):
            data = np.concatenate([data, np.zeros(need - len(data), np.uint8)])
            echo = np.concatenate([echo, np.zeros((need - len(echo), echo.shape[1]), np.float32)])
        x = np.concatenate([self.p["bytes"][data], echo], 1)
        return np.lib.stride_tricks.sliding_window_view(x, CHUNK, 0)[::STRIDE].transpose(0, 2, 1).reshape(len(rows), -1)

    def activations(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Largest and mean activation of each filter over the whole text."""
        data = np.frombuffer(text, np.uint8)
        echo = echoes(data)
        top, total, count = np.zeros(FILTERS, np.float32), np.zeros(FILTERS, np.float64), 0
        for at in range(0, max(len(data) - CHUNK, 0) + STRIDE, _SLAB):
            upto = at + _SLAB - STRIDE + CHUNK
            h = np.maximum(self.chunks(data[at:upto], echo[at:upto]) @ self.p["filters"] + self.p["bias"], 0)
            top, total, count = np.maximum(top, h.max(0)), total + h.sum(0), count + len(h)
        return top, (total / count).astype(np.float32)

    def score(self, text: str | None) -> float:
        top, mean = self.activations((text or "").encode("utf-8", "replace"))
        z = float(np.concatenate([top, mean]) @ self.p["out"] + self.p["base"][0])
        return 1 / (1 + math.exp(-max(min(z, 30), -30)))

    def gradients(self, batch: list[tuple[np.ndarray, np.ndarray, float]]) -> dict[str, np.ndarray]:
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        width = CHANNELS + len(_ECHOES)
        for data, echo, y in batch:
            x = self.chunks(data, echo)
            h = np.maximum(x @ self.p["filters"] + self.p["bias"], 0)
            win = h.argmax(0)
            top, mean = h.max(0), h.mean(0)
            f = np.concatenate([top, mean])
            d = 1 / (1 + np.exp(-np.clip(f @ self.p["out"] + self.p["base"][0], -30, 30))) - y
            g["out"] += d * f
            g["base"] += d
            dh = np.broadcast_to(d * self.p["out"][FILTERS:] / len(h), h.shape).copy()
            dh[win, np.arange(FILTERS)] += d * self.p["out"][:FILTERS]
            dh *= h > 0
            g["filters"] += x.T @ dh
            g["bias"] += dh.sum(0)
            # To the byte vectors only from the chunks that won: they carry nearly all of it.
            won = np.unique(win)
            dx = (dh[won] @ self.p["filters"].T).reshape(len(won), CHUNK, width)[:, :, :CHANNELS]
            at = won[:, None] * STRIDE + np.arange(CHUNK)
            inside = at < len(data)
            np.add.at(g["bytes"], data[at[inside]], dx[inside])
        return {k: v / len(batch) for k, v in g.items()}


def fit(sample: list[tuple[str, int]], seed: int = 7) -> ByteNetwork:
    """Adam over batches that hold as many bad texts as good ones."""
    net, r = ByteNetwork(seed), np.random.default_rng(seed)
    good = [(t, y) for t, y in sample if y]
    bad = [(t, y) for t, y in sample if not y]
    if not good or not bad:
        share = (len(good) + 1) / (len(sample) + 2)
        net.p["out"][:] = 0
        net.p["base"][:] = math.log(share / (1 - share))
        return net
    ready = [[(d := np.frombuffer(t.encode("utf-8", "replace"), np.uint8), echoes(d), float(y)) for t, y in part] for part in (good, bad)]
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    for step in range(1, STEPS + 1):
        batch = [part[i] for part in ready for i in r.integers(0, len(part), BATCH // 2)]
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for k, g in net.gradients(batch).items():
            if k in ("filters", "out"):
                g = g + 1e-4 * net.p[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            net.p[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def add_score(docs: DataFrame, net: ByteNetwork) -> DataFrame:
    """doc_id and score of each row."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = [net.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score, pa.float64())], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(scored, "doc_id long, score double")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, max_bytes: int = MAX_BYTES) -> ByteNetwork:
    return fit(labelled_sample(docs, labels, "quality", sample, max_bytes))


@query("op1_quality")
def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    net = train(docs, table(spark, folder, "labels"))
    return add_score(docs, net).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= KEEP).cast("int").alias("predicted")
    )
