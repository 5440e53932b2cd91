"""Language identification by averaged hashed subword embeddings and a linear softmax, with calibrated rejection.

A text is lower-cased and every character that is no letter becomes a space. Its features are the letter n-grams of two
to four characters with word ends, hashed into BUCKETS; each has an embedding, and the text is their mean. A linear layer
and a softmax give the language. Embeddings and layer are trained together by stochastic gradient descent in numpy, on
whole texts and on short cuts of them, from a bounded sample: about TRAIN_ROWS labelled documents, as many of each
language, chosen by a hash of the id. Only hashed counts of the sample reach the driver, at most BUCKETS per example.

A fifth of the sample is kept back for calibration: a temperature that makes the confidence honest, and the confidence
below which a prediction is rejected, so low that at most REJECT of the correctly told calibration texts fall below it
and never above MOST_REJECTED. Embeddings that training never touched are zero: a text in an unknown script gets every
language with the same probability and is rejected.

A null text or one without a letter is `und` with score 0 and rejected; so is every text if nothing could be learned.
Whole texts count, in slabs; empty tables give empty results; rows are judged one by one, so repeated rows agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 1 << 17
DIM = 16
LENGTHS = (2, 3, 4)
TRAIN_ROWS = 2000
CUTS = 3
EPOCHS = 4
RATE = 4.0
REJECT = 0.001
MOST_REJECTED = 0.5
SLAB = 1 << 20
MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)
RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                       T.StructField("rejected", T.BooleanType())])

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def code_points(text: str) -> np.ndarray:
    """Letters of the lower-cased text, all else as spaces, with a space at either end."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(letters()[points], points, np.uint32(32))


def ngrams(points: np.ndarray) -> Iterator[np.ndarray]:
    """Per n, the bucket of the n-gram that starts at each position; 0 where there is none (inner space, or only spaces)."""
    gap = points == 32
    for n in LENGTHS:
        size = len(points) - n + 1
        if size <= 0:
            continue
        code = np.full(size, n, np.uint32)
        for k in range(n):
            code = (code ^ points[k:k + size]) * MULTIPLIERS[k]
            code ^= code >> np.uint32(15)
        bucket = code % np.uint32(BUCKETS - 1) + np.uint32(1)
        out = gap[:size] & gap[n - 1:]
        for k in range(1, n - 1):
            out = out | gap[k:k + size]
        bucket[out] = 0
        yield bucket


def slabs(text: str) -> Iterator[str]:
    for i in range(0, max(len(text), 1), SLAB):
        yield text[i:i + SLAB]


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and how often each occurs."""
    total = np.zeros(BUCKETS, np.int64)
    for part in slabs(text):
        for bucket in ngrams(code_points(part)):
            total += np.bincount(bucket, minlength=BUCKETS)
    total[0] = 0
    at = np.flatnonzero(total)
    return at.astype(np.uint32), total[at].astype(np.uint32)


class Model:
    """table: per bucket the contribution to the logits, embedding and layer multiplied out where that is smaller."""

    def __init__(self, langs: list[str], embedding: np.ndarray, layer: np.ndarray, bias: np.ndarray):
        self.langs, self.bias, self.temperature, self.threshold = langs, bias, 1.0, 0.0
        small = len(langs) <= embedding.shape[1]
        self.table = (embedding @ layer if small else embedding).astype(np.float32)
        self.table[0] = 0  # no n-gram
        self.layer = None if small else layer.astype(np.float32)

    def logits(self, sums: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        mean = sums / np.maximum(sizes, 1)[:, None]
        return (mean if self.layer is None else mean @ self.layer) + self.bias

    def sums(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Summed table rows and number of n-grams of each text; short texts are done together."""
        total, size = np.zeros((len(texts), self.table.shape[1])), np.zeros(len(texts), np.int64)
        todo: list[tuple[int, np.ndarray]] = []

        def flush() -> None:
            if not todo:
                return
            points = np.concatenate([p for _, p in todo])
            starts = np.concatenate(([0], np.cumsum([len(p) for _, p in todo])[:-1]))
            which = np.array([i for i, _ in todo])
            for bucket in ngrams(points):
                cut = starts[starts < len(bucket)]
                np.add.at(total, which[:len(cut)], np.add.reduceat(self.table[bucket], cut, axis=0))
                np.add.at(size, which[:len(cut)], np.add.reduceat(bucket > 0, cut, dtype=np.int64))
            todo.clear()

        held = 0
        for i, text in enumerate(texts):
            for part in slabs(text):
                points = code_points(part)
                todo.append((i, points))
                held += len(points)
                if held > SLAB // 4:
                    flush()
                    held = 0
        flush()
        return total, size

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def train(examples: list[tuple[int, np.ndarray, np.ndarray]], langs: list[str], seed: int = 11) -> Model:
    """examples: (language number, buckets, counts). Plain SGD, one example a step, the rate falling to zero."""
    random = np.random.default_rng(seed)
    embedding = np.zeros((BUCKETS, DIM), np.float32)
    layer = random.normal(0, 0.5, (DIM, len(langs))).astype(np.float32)
    bias = np.zeros(len(langs), np.float32)
    steps, step = EPOCHS * len(examples), 0
    for _ in range(EPOCHS):
        for i in random.permutation(len(examples)):
            lang, bucket, count = examples[i]
            if not len(bucket):
                continue
            rate, step = RATE * (1 - step / steps), step + 1
            share = (count / count.sum()).astype(np.float32)
            mean = share @ embedding[bucket]
            z = mean @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[lang] -= 1
            back = layer @ p
            layer -= 0.1 * rate * np.outer(mean, p)
            # Frequent n-grams of a text must not drown the rest: their step grows with the root of their share.
            embedding[bucket] -= rate * np.sqrt(share)[:, None] * back
    return Model(langs, embedding, layer, bias)


def calibrate(model: Model, logits: np.ndarray, truth: np.ndarray, reject: float = REJECT) -> None:
    """Temperature by least log loss on a grid, then the confidence below which a prediction is rejected."""
    if not len(truth):
        return
    grid = np.geomspace(0.05, 20, 121)

    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(1)) - z[np.arange(len(truth)), truth]))

    model.temperature = float(min(grid, key=loss))
    p = model.probabilities(logits)
    right = p.max(1)[p.argmax(1) == truth]
    if len(right):
        model.threshold = min(MOST_REJECTED, float(np.quantile(right, reject, method="lower")))


EXAMPLE = "lang string, hold boolean, bucket binary, count binary"


def _examples(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for lang, text, hash_ in zip(frame["lang"], frame["text"], frame["hash"]):
            random = np.random.default_rng(abs(int(hash_)))
            parts = [text]
            for _ in range(CUTS):
                size = int(random.integers(15, 200))
                start = int(random.integers(0, max(1, len(text) - size)))
                parts.append(text[start:start + size])
            for part in parts:
                bucket, count = counts(part)
                if len(bucket):
                    rows.append((lang, int(hash_) % 5 == 0, bucket.tobytes(), count.tobytes()))
        yield pd.DataFrame(rows, columns=["lang", "hold", "bucket", "count"])


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        train_rows: int = TRAIN_ROWS) -> Model | None:
    """Learn from a bounded sample of labelled rows (null text or language does not count)."""
    rows = labelled.select(F.col(key).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")
                           ).where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    langs = sorted(sizes)
    share = F.element_at(F.create_map(*[F.lit(v) for name in langs for v in
                                        (name, min(1.0, train_rows / len(langs) / sizes[name]))]), F.col("lang"))
    draw = F.pmod(F.xxhash64("id", F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(draw < share).select("lang", "text", F.xxhash64("id", F.lit(5)).alias("hash"))
    number = {name: i for i, name in enumerate(langs)}
    kept, held = [], []
    for r in sorted(sample.mapInPandas(_examples, EXAMPLE).collect()):
        example = (number[r.lang], np.frombuffer(r.bucket, np.uint32), np.frombuffer(r["count"], np.uint32))
        (held if r.hold else kept).append(example)
    if not kept:
        kept = held
    if not kept:
        return None
    model = train(kept, langs)
    if held:
        sums = np.stack([c @ model.table[b] for _, b, c in held])
        sizes_ = np.array([c.sum() for _, _, c in held])
        calibrate(model, model.logits(sums, sizes_), np.array([n for n, _, _ in held]))
    return model


def predictor(model: Model | None, spark):
    """A function of the text column that gives lang_pred, score and rejected."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def predict(text: pd.Series) -> pd.DataFrame:
        model, texts = shared.value, [t or "" for t in text]
        lang = np.full(len(texts), "und", dtype=object)
        score, rejected = np.zeros(len(texts)), np.ones(len(texts), bool)
        if model is not None and texts:
            sums, sizes = model.sums(texts)
            p = model.probabilities(model.logits(sums, sizes))
            best, confidence, some = p.argmax(1), p.max(1), sizes > 0
            lang[some] = np.array(model.langs, dtype=object)[best[some]]
            score[some] = confidence[some]
            rejected = ~some | (confidence < model.threshold)
        return pd.DataFrame({"lang_pred": lang, "score": score, "rejected": rejected})

    return predict


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> Column:
    return predictor(model, docs.sparkSession)(F.col(text))


def keep_known(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows of docs that are not rejected, with all their columns."""
    body = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("body"), F.col(f"`{text}`").alias("text"))
    return body.withColumn("told", predict(body, model)).where(~F.col("told.rejected")).select("body.*")
