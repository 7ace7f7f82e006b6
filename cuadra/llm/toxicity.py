"""Toxicity by compression distance.

Two zstandard dictionaries share their ordinary text. The toxic one has, behind that, what is
typical of toxic documents: words that occur there in several different surroundings and in no
ordinary document. A window of a text that the toxic dictionary makes shorter than the ordinary one
holds something toxic; windows that neither knows come out alike.

Fitting works on a bounded sample of labelled rows outside the held-out fold: at most ``sample`` of
each class, of at most ``max_bytes`` each, the same rows on every run. One half fills the dictionaries.
On the other half, the saving that a window must reach is set so that ordinary documents have next to
none, and the saving of a document's best window is turned into a probability. The rows are weighted to the
share that each class has among all labelled rows, so the size of a table does not change a score. Scoring compresses every window of
every text, inside the tasks that read them, without a shuffle.

Cases: null text counts as empty; an empty text has no window and the lowest score. Repeated rows are
all scored. Rows without a label, with an id that has no document, or of one class only leave a model
that gives every text the share of the toxic labels and rejects nothing. Extra columns are carried along by ``reject``.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuadra.llm.common import held_out, query, table

SAMPLE = 3000  # labelled documents of each class
MAX_BYTES = 32_768  # longer documents are not learned from
WINDOW, STRIDE = 64, 40  # bytes; a word of up to 24 bytes lies in one window as a whole
ORDINARY_BYTES, TOXIC_BYTES = 100_000, 12_000
LEAD = 32  # bytes before each window
# No UTF-8 text holds these bytes in such an order.
FILLER = bytes(128 + b % 64 for b in np.random.default_rng(5).bytes(TOXIC_BYTES))
# zstandard's settings (strategy, search depth, shortest match, target length). A window counts with the
# least that any of these parsers saves: a whole word helps all of them, a match by chance seldom does.
PARSERS = ((3, 4, 5, 0), (3, 4, 6, 0), (6, 6, 6, 64), (6, 6, 5, 64))
REJECT = 0.5

_WORD = re.compile(r"\w+")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_bytes: int) -> list[tuple[str, int]]:
    """(text, label) of the training sample, chosen by a hash of the id before any text is read."""
    known = labels.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max(label).alias("_y")).filter("_y in (0, 1)")
    picked = [known.filter(F.col("_y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    # At most 2 * per_class rows of ids.
    chosen = F.broadcast(picked[0].unionByName(picked[1]))
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").filter(F.octet_length("text").between(1, max_bytes))
    got = rows.select("doc_id", "text", "_y").dropDuplicates(["doc_id"]).collect()
    return [(r.text, r._y) for r in sorted(got, key=lambda r: r.doc_id)]


def class_counts(docs: DataFrame, labels: DataFrame, label: str) -> tuple[int, int]:
    """How many documents outside the held-out fold are labelled 0 and 1."""
    known = labels.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max(label).alias("_y")).filter("_y in (0, 1)")
    n = {r._y: r["count"] for r in known.join(docs.select("doc_id"), "doc_id", "left_semi").groupBy("_y").count().collect()}
    return n.get(0, 0), n.get(1, 0)


def windows(text: str) -> list[bytes]:
    """Overlapping windows over the whole text, lower-cased."""
    data = text.lower().encode("utf-8", "replace")
    return [data[i:i + WINDOW] for i in range(0, max(len(data) - WINDOW + STRIDE, 1), STRIDE)] if data else []


def typical_words(toxic: list[str], ordinary: list[str]) -> list[str]:
    """Words of toxic texts only, the most frequent last.

    A word counts once for each pair of neighbours that it has, so copies of one text count once.
    """
    usual = {w for t in ordinary for w in _WORD.findall(t.lower())}
    around = defaultdict(set)
    for t in toxic:
        run = ["", *_WORD.findall(t.lower()), ""]
        for a, w, b in zip(run, run[1:], run[2:]):
            if w not in usual:
                around[w].add((a, b))
    least = max(3, len(toxic) // 60)
    often = sorted((len(s), w) for w, s in around.items() if len(s) >= least)
    return [w for _, w in often]


class CompressionModel:
    """Dictionaries, the saving that counts, and the step from windows to a probability."""

    def __init__(self, ordinary: bytes, toxic: bytes, saving: float = 0.0, slope: float = 0.0, base: float = 0.0):
        self.ordinary, self.toxic, self.saving, self.slope, self.base = ordinary, toxic, saving, slope, base
        self._coders = {}

    def __getstate__(self):
        return self.__dict__ | {"_coders": {}}

    def _saved(self, some: list[bytes], settings: tuple[int, int, int, int]) -> np.ndarray:
        """Compressed length with the ordinary dictionary less that with the toxic one."""
        import zstandard

        if settings not in self._coders:
            strategy, depth, match, target = settings
            how = zstandard.ZstdCompressionParameters(
                strategy=strategy, search_log=depth, min_match=match, target_length=target, window_log=18, hash_log=18,
                chain_log=18, write_content_size=False, write_checksum=False, write_dict_id=False)
            coders = []
            # The typical words stand nearest to a window, where a match costs least; as many bytes that
            # match nothing keep the shared text at the same distance in both.
            for content in (self.ordinary + FILLER[:len(self.toxic)], self.ordinary + self.toxic):
                known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                known.precompute_compress(compression_params=how)
                coders.append(zstandard.ZstdCompressor(dict_data=known, compression_params=how))
            self._coders[settings] = coders
        lengths = []
        # A window alone may be too short to pay for a compressed block and be stored as it is. With a
        # lead that both dictionaries end in, each further match shows in the length.
        lead = self.ordinary[-LEAD:]
        led = [lead + w for w in some]
        for coder in self._coders[settings]:
            packed = coder.multi_compress_to_buffer(led, threads=1)
            lengths.append(np.fromiter(map(len, packed), np.int64, len(packed)))
        return lengths[0] - lengths[1]

    def savings(self, texts: list[str]) -> list[np.ndarray]:
        """Bytes that the toxic dictionary saves, for each window of each text."""
        cut = [windows(t) for t in texts]
        flat = [w for c in cut for w in c]
        if not flat or not self.toxic:
            return [np.zeros(0, np.int64) for _ in texts]
        saved = np.zeros(len(flat), np.int64)
        for at in range(0, len(flat), 20_000):
            some = flat[at:at + 20_000]
            least = np.full(len(some), np.iinfo(np.int64).max)
            left = np.arange(len(some))
            for parser in PARSERS:  # each looks only at windows in which those before it saved something
                least[left] = np.minimum(least[left], self._saved([some[i] for i in left], parser))
                left = left[least[left] > 0]
                if not len(left):
                    break
            saved[at:at + len(some)] = np.maximum(least, 0)
        return np.split(saved, np.cumsum([len(c) for c in cut])[:-1])

    def evidence(self, gains: np.ndarray) -> float:
        """Grows with the bytes saved in the best window, if they reach the threshold; so length is no evidence."""
        top = int(gains.max(initial=0))
        return math.log1p(top) if top >= self.saving else 0.0

    def scores(self, texts: list[str]) -> list[float]:
        return [1 / (1 + math.exp(-(self.base + self.slope * self.evidence(g)))) for g in self.savings(texts)]


def fit(sample: list[tuple[str, int]], counts: tuple[int, int] | None = None) -> CompressionModel:
    """Dictionaries from one half of each class of the sample, thresholds from the other half.

    ``counts`` (ordinary, toxic) are the labelled rows that the sample stands for; its rows are weighted back to them.
    """
    classes = [[r for r in sample if r[1] == y] for y in (0, 1)]
    ordinary, toxic = ([t for t, _ in part[::2]] for part in classes)
    rest = classes[0][1::2] + classes[1][1::2]
    counts = counts or tuple(len(part) for part in classes)
    share = (counts[1] + 1) / (sum(counts) + 2)
    prior = math.log(share / (1 - share))
    # Without two rows of each class there is nothing to compare, or nothing to set thresholds on.
    words = typical_words(toxic, ordinary) if min(map(len, classes)) > 1 else []
    if not words:
        return CompressionModel(b"", b"", base=prior)
    common = " ".join(t.lower() for t in ordinary).encode()[-ORDINARY_BYTES:]
    typical = (" ".join(words) + " ").encode()[-TOXIC_BYTES:]
    model = CompressionModel(common, typical)
    gains = model.savings([t for t, _ in rest])
    y = np.array([l for _, l in rest])
    weight = np.array([counts[l] / len(classes[l]) for l in y])
    weight *= len(y) / weight.sum()
    best = None
    for saving in range(1, 12):
        model.saving = saving
        x = np.array([model.evidence(g) for g in gains])
        slope, base = logistic(x, y, weight)
        loss = float(np.mean(weight * (np.logaddexp(0, base + slope * x) - y * (base + slope * x))))
        if best is None or loss < best[0]:
            best = (loss, saving, slope, base)
    _, model.saving, model.slope, model.base = best
    return model


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 50, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and intercept of a slightly damped logistic regression of weighted rows, by Newton steps."""
    a = np.stack([x, np.ones_like(x)], 1)
    w = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (weight * p * (1 - p))[:, None]).T @ a + ridge * np.eye(2)
        w -= np.linalg.solve(h, a.T @ (weight * (p - y)) + ridge * w)
    return float(w[0]), float(w[1])


def add_score(docs: DataFrame, model: CompressionModel, name: str = "score") -> DataFrame:
    """``docs`` with the probability of being toxic as its last column."""
    at = docs.columns.index("text")
    kinds = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in docs.schema)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.scores([t or "" for t in batch.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], [*batch.schema.names, name])

    return docs.mapInArrow(scored, f"{kinds}, {name} double")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, max_bytes: int = MAX_BYTES) -> CompressionModel:
    return fit(labelled_sample(docs, labels, "toxic", sample, max_bytes), class_counts(docs, labels, "toxic"))


def reject(docs: DataFrame, model: CompressionModel, at: float = REJECT) -> DataFrame:
    """The rows of ``docs`` whose score is below ``at``, with their columns; all rows if the model has no evidence."""
    if not model.toxic:
        return docs
    taken = [f"c{i}" for i in range(len(docs.columns))]
    # Names are set aside, since ``docs`` may have a column of any name, or one that clashes.
    plain = docs.toDF(*["text" if c == "text" else t for c, t in zip(docs.columns, taken)])
    return add_score(plain, model, "_toxic").filter(F.col("_toxic") < at).drop("_toxic").toDF(*docs.columns)


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = train(docs, table(spark, folder, "labels"))
    return add_score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", ((F.col("score") >= REJECT) & F.lit(bool(model.toxic))).cast("int").alias("predicted")
    )
