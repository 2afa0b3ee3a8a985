"""Quality scores from zstandard dictionaries.

Two dictionaries are built, from good and from bad labelled texts. A text is compressed with either, in chunks of
``chunk_bytes``, so that a text that repeats itself, or a long one, can't do without the dictionary after its first lines.
(Bytes with the bad dictionary - bytes with the good one) / bytes of the text is large for text that resembles good text.
A logistic calibration on held-back labelled rows turns that difference into a probability, with an intercept and a slope
that follow the logarithm of the length, as the difference spreads for short texts. Nothing else enters a score.

Bounds, all parameters: ``max_rows`` labelled ids of each class, those of smallest hash, one text of ``max_text_bytes`` at most
for each, and of these as many as fit in ``max_class_bytes``. Of four of them three go into the dictionaries, cut into samples
of ``sample_bytes`` up to ``max_bytes`` of a class, and one into the calibration. These texts are what comes to the driver.

Defined cases: null and empty texts score by the calibration's intercept alone. Rows with a null label or id, and
those that ``learn_from`` leaves out, teach nothing; repeated labels of a document with one value count once, contrary ones not
at all; of several rows with a labelled id the text of smallest hash teaches. If a class has too few rows for a
dictionary the score is the labelled share of good rows, 0.5 if there is none. Equal texts score alike. An
empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.common import map_batches, text_or_empty


@dataclass(frozen=True)
class Settings:
    max_rows: int = 3000
    max_text_bytes: int = 65_536
    max_class_bytes: int = 32_000_000
    chunk_bytes: int = 128
    sample_bytes: int = 1024
    max_bytes: int = 8_000_000
    dict_bytes: int = 112_640
    level: int = 3
    ridge: float = 1e-5


@dataclass(frozen=True)
class Model:
    """The dictionaries (empty: none) and the calibration's weights; under 2 * dict_bytes in all."""

    good: bytes
    bad: bytes
    level: int
    chunk_bytes: int
    weights: tuple[float, ...]

    def scorer(self):
        """A function from a text to its score."""
        if not self.good:
            return lambda text: self.weights[0]
        good, bad = compressor(self.good, self.level), compressor(self.bad, self.level)
        w = np.asarray(self.weights)

        def score(text):
            z = float(features(text, good, bad, self.chunk_bytes) @ w)
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

        return score


def compressor(dictionary: bytes, level: int):
    d = zstandard.ZstdCompressionDict(dictionary)
    d.precompute_compress(level=level)
    return zstandard.ZstdCompressor(dict_data=d).compress


def features(text: str | None, good, bad, chunk: int) -> np.ndarray:
    """1, the normalised difference, the length's logarithm (0 at 1,000 bytes), and the product of the two."""
    data = (text or "").encode("utf-8", "surrogatepass")
    if not data:
        return np.array([1.0, 0, 0, 0])
    x = 0
    for k in range(0, len(data), chunk):
        part = data[k : k + chunk]
        x += len(bad(part)) - len(good(part))
    x, size = x / len(data), math.log(len(data) / 1000)
    return np.array([1.0, x, size, x * size])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> np.ndarray:
    """Newton's method with halved steps, so that each one lowers the loss; the ridge keeps separable classes finite."""

    def loss(w):
        z = x @ w
        return np.mean(np.logaddexp(0, z) - y * z) + ridge / 2 * w @ w

    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) / len(y) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge * np.eye(len(w))
        step, now = np.linalg.solve(hess, grad), loss(w)
        while loss(w - step) > now and np.abs(step).max() > 1e-9:
            step /= 2
        w = w - step
        if np.abs(step).max() < 1e-7:
            break
    return w


def build_dictionary(texts: list[str], s: Settings) -> bytes:
    samples, size = [], 0
    for t in texts:
        data = t.encode("utf-8", "surrogatepass")
        for k in range(0, len(data), s.sample_bytes):
            if size < s.max_bytes:
                samples.append(data[k : k + s.sample_bytes])
                size += len(samples[-1])
    if len(samples) < 8 or size < 2000:
        return b""
    try:
        return zstandard.train_dictionary(min(s.dict_bytes, max(1024, size // 4)), samples).as_bytes()
    except zstandard.ZstdError:  # samples too alike or too short to build from
        return b""


def train(docs: DataFrame, labels: DataFrame, learn_from: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", settings: Settings = Settings()) -> Model:
    """Learn from the labelled rows for which ``learn_from`` (a condition on ``id_col``) holds."""
    known = (
        labels.where(learn_from & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.min(label_col).alias("y"), F.max(label_col).alias("y2"))
        .where("y = y2")
        .select("id", "y")
    )
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    texts = texts.where((F.col("text") != "") & (F.octet_length("text") <= settings.max_text_bytes))
    order = F.xxhash64("id", F.lit("quality"))
    share = known.groupBy("y").count().collect()  # two rows
    # the bounded sample of ids is drawn first, so that only its texts move
    picked = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(order, "id").limit(settings.max_rows)
        picked = part if picked is None else picked.unionByName(part)
    texts = texts.join(F.broadcast(picked), "id").groupBy("id", "y").agg(F.min(F.struct(F.xxhash64("text"), "text"))["text"].alias("text"))
    # 2 * max_rows rows at most, of which those come to the driver that fit in the bytes
    upto = Window.partitionBy("y").orderBy("o", "id").rowsBetween(Window.unboundedPreceding, 0)
    sized = texts.select("id", "text", "y", order.alias("o")).withColumn("upto", F.sum(F.octet_length("text").cast("bigint")).over(upto))
    rows = sized.where(F.col("upto") <= settings.max_class_bytes).select("id", "text", "y", "o").collect()
    rows.sort(key=lambda r: (r.o, r.id))
    n = {r.y: r["count"] for r in share}
    prior = n.get(1, 0) / sum(n.values()) if n else 0.5
    sides = {y: [r.text for r in rows if r.y == y] for y in (0, 1)}
    good, bad = (build_dictionary([t for k, t in enumerate(sides[y]) if k % 4], settings) for y in (1, 0))
    if not good or not bad:
        return Model(b"", b"", settings.level, settings.chunk_bytes, (prior,))
    fns = [compressor(data, settings.level) for data in (good, bad)]
    held = [(t, y) for y in (0, 1) for t in sides[y][::4]]
    x = np.array([features(t, *fns, settings.chunk_bytes) for t, _ in held])
    y = np.array([v for _, v in held], float)
    w = fit_logistic(x, y, settings.ridge)
    # the sample may be more even than the labels are: move the intercept to the labelled share
    a, b = y.mean(), prior
    if 0 < a < 1 and 0 < b < 1:
        w[0] += math.log(b / (1 - b)) - math.log(a / (1 - a))
    return Model(good, bad, settings.level, settings.chunk_bytes, tuple(w.tolist()))


def score_documents(docs: DataFrame, model: Model, threshold: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score, predicted (1 if score >= threshold). A scan, no shuffle; the model goes along with the tasks."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by Settings

    def run(batches):
        score = shared.value.scorer()
        for ids, texts in batches:
            s = [score(t) for t in texts]
            yield {"id": ids, "score": s, "predicted": [int(v >= threshold) for v in s]}

    out = map_batches(docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text"), ("id", "text"), f"id {kind}, score double, predicted int", run)
    return out.withColumnRenamed("id", id_col)
