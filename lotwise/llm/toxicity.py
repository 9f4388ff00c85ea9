"""Operator 2: toxicity by compression distance.

Two zstandard dictionaries are trained, one on text of toxic documents and one on text of
ordinary ones. Every word of a document is a window; a window's gain is how many bytes
shorter it gets with the toxic dictionary than with the ordinary one. A logistic model over
the counts of windows that reach each gain, fitted on labelled documents that the
dictionaries have not seen, is the calibrated threshold.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm.common import by_value, per_worker, table, with_fields

#: Bounds of the sample that the model is fitted on: documents of each class, bytes of all.
MAX_TOXIC, MAX_ORDINARY, MAX_BYTES = 2000, 8000, 60_000_000
LEVEL, TOXIC_BYTES, ORDINARY_BYTES = 12, 16384, 110_000
GAINS = range(1, 11)
#: Windows remembered per worker process (about 25 MB).
CACHE = 200_000

_WINDOW = re.compile(r"[^\W\d_]{1,32}")
# Both dictionaries end with these bytes and so does each compressed window: a short input
# alone would be stored without compression, and its last bytes are never searched.
_CARRIER = bytes(128 + 37 * i * i % 64 for i in range(48))


@dataclass
class Model:
    """A fitted classifier; its size does not depend on the data's."""

    toxic: bytes
    ordinary: bytes
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def key(self) -> str:
        parts = (self.toxic, self.ordinary, self.centre.tobytes(), self.scale.tobytes(), self.weights.tobytes())
        return hashlib.sha256(b"".join(parts)).hexdigest()


class Gains(dict):
    """Gain of each window, by the two dictionaries."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.toxic, self.ordinary = _compressor(toxic), _compressor(ordinary)

    def __missing__(self, window: str) -> int:
        data = f" {window} ".encode() + _CARRIER
        gain = len(self.ordinary.compress(data)) - len(self.toxic.compress(data))
        if len(self) < CACHE:
            self[window] = gain
        return gain

    def features(self, text: str | None) -> np.ndarray:
        windows = _WINDOW.findall((text or "").lower())
        gains = np.fromiter(map(self.__getitem__, windows), np.int16, len(windows))
        reached = np.array([np.count_nonzero(gains >= g) for g in GAINS], float)
        return np.concatenate([np.log1p(reached), reached / (len(windows) + 5.0) * 20, [np.log1p(len(windows))]])


def _compressor(dictionary: bytes):
    import zstandard

    data = zstandard.ZstdCompressionDict(dictionary + _CARRIER, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False
    )


def _dictionary(size: int, windows: list[str]) -> bytes:
    import zstandard

    order = np.random.default_rng(0).permutation(len(windows))
    samples = ["".join(f" {windows[i]} " for i in order[at : at + 4]).encode() for at in range(0, len(windows), 4)]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        # Too few samples for training: the text itself.
        return b"".join(samples)[:size]


def _trained(texts: list[str | None], toxic: list[int]) -> tuple[bytes, bytes]:
    """The toxic and the ordinary dictionary. Toxic documents are ordinary but for some
    windows, so the toxic dictionary learns those that they hold far more often."""
    seen, count = {0: Counter(), 1: Counter()}, Counter(toxic)
    for text, label in zip(texts, toxic):
        seen[label].update(set(_WINDOW.findall((text or "").lower())))
    least = 2 if count[1] >= 100 else 1
    more = [
        w for w, n in sorted(seen[1].items())
        if n >= least and n * max(1, count[0]) > 4 * (seen[0][w] + 0.5) * count[1]
    ]
    return (
        _dictionary(TOXIC_BYTES, [w for w in more for _ in range(min(30, seen[1][w]))]),
        _dictionary(ORDINARY_BYTES, [w for w, n in sorted(seen[0].items()) for _ in range(min(4, n))]),
    )


def fit(texts: list[str | None], toxic: list[int]) -> Model:
    """Model from labelled texts: three of four train the dictionaries, every fourth the
    thresholds. Without any toxic text all scores are near 0."""
    place = {0: 0, 1: 0}
    known, rest = ([], []), ([], [])
    for text, label in zip(texts, toxic):
        place[label] += 1
        for column, value in zip(rest if place[label] % 4 == 0 else known, (text, label)):
            column.append(value)
    dictionaries = _trained(*known)
    gains = Gains(*dictionaries)
    rows = [(gains.features(t), y) for t, y in zip(*rest)] or [(gains.features(""), 0)]
    x, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    centre, scale = x.mean(0), x.std(0) + 1e-9
    return Model(*dictionaries, centre, scale, _logistic((x - centre) / scale, y))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the last weight is the intercept."""
    x = np.c_[x, np.ones(len(x))]
    w, kept = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + kept, x.T @ (p - y) + kept @ w)
    return w


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document's label is never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit_on(docs: DataFrame, labels: DataFrame) -> Model:
    """``fit`` on a bounded sample of labelled documents that are not held out: at most
    ``MAX_TOXIC`` and ``MAX_ORDINARY`` documents of the smallest hashes. Beyond ``MAX_BYTES``
    the longest texts of the class that holds more leave it, so that the other class keeps
    all that half of the bound has room for. Null labels and ids are left out; of labels that
    disagree the toxic one counts."""
    known = labels.filter(F.col("toxic").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = None
    for label, bound in ((1, MAX_TOXIC), (0, MAX_ORDINARY)):
        part = known.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most MAX_TOXIC + MAX_ORDINARY ids.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    # A text that is longer than the bound alone never comes to the driver.
    sample = sample.filter(F.coalesce(F.length("text"), F.lit(0)) <= MAX_BYTES)
    kept, held, longest = {}, {0: 0, 1: 0}, {0: [], 1: []}
    for place, row in enumerate(sample.limit(MAX_TOXIC + MAX_ORDINARY).toLocalIterator()):
        size, label = len(row["text"] or ""), int(row["toxic"])
        kept[place] = (row["text"], label)
        held[label] += size
        heapq.heappush(longest[label], (-size, place))
        while sum(held.values()) > MAX_BYTES:
            more = max(held, key=held.get)
            size, out = heapq.heappop(longest[more])
            held[more] += size
            del kept[out]
    return fit([t for t, _ in kept.values()], [y for _, y in kept.values()])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` to all rows; input columns of these names are
    replaced. Null and empty texts have no windows and get the score of that. Texts of any
    length are scored whole."""
    docs = docs.drop("score", "predicted")
    at = docs.columns.index("text")
    key = model.key()

    def batches(rows):
        gains = per_worker(("toxicity", key), lambda: Gains(model.toxic, model.ordinary))
        for batch in rows:
            x = np.array([gains.features(t) for t in batch.column(at).to_pylist()]).reshape(-1, len(model.centre))
            z = np.c_[(x - model.centre) / model.scale, np.ones(len(x))] @ model.weights
            score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            made = [pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32), pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, "score", "predicted"])

    return docs.mapInArrow(batches, with_fields(docs, "score double, predicted int"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents, learnt from the labelled ones that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rated = scored(docs, fit_on(docs, table(spark, sf_dir, "labels")))
    return rated.select("doc_id", held_out().alias("held_out"), "score", "predicted")


by_value(__name__)
