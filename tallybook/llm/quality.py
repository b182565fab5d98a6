"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight per hashed text feature is shared by all grades, and ordered thresholds cut the score into grades:
P(grade > k) = sigmoid(score - threshold_k).  A document gets its expected grade and the probability of the top grade
(the tail), by which it is selected.

A word gives features: itself (lower case, without punctuation at its ends), its first four and five letters, the signs
at its end, whether it is all capitals, all digits or all signs.  The score is the mean over the words, so it does not depend
on the length and a word's part of it can be kept in a cache.

The model is fitted on a bounded sample of rated documents (``SAMPLE``, by a hash of the id) in one task; everything
else runs over whole texts of all documents.  The model has a fixed size (``BUCKETS`` floats), so its broadcast is bounded.

Cases: NULL and empty texts have no features and get the grade that the thresholds alone give; NULL ratings don't count;
without ratings of two grades the fit keeps every weight at 0; of rows with one rated id the smallest text is fitted; ties of the
sample's hash go by id and grade; repeated rows score alike; very long texts are scored whole; further columns are kept, but one
named like a result is replaced.
"""

from __future__ import annotations

import dataclasses
import math
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free, others
from .vector import Recent, slices, spread, word_codes

BUCKETS = 1 << 18
SAMPLE = 8000
ROUNDS = 200
MIN_DOCS = 3
RIDGE = 1e-3
RATE = 0.3
SCALE = 100.0
TAIL = 0.4
CACHE_SIZE = 200_000
FIT_BYTES = 1 << 19  # texts of the sample that are taken at once


def _seed(kind: str) -> int:
    return zlib.crc32(kind.encode())


_WORD, _FOUR, _FIVE, _TAIL, _UPPER, _SIGN, _DIGIT = (_seed(k) for k in ("w", "4", "5", "t", "upper", "sign", "digit"))
MARKS = string.punctuation


def word_features(raw: str) -> list[int]:
    """Buckets of a word's features; a feature is hashed as the letter of its kind and its text."""
    core = raw.strip(MARKS)
    low = core.lower()
    out = [zlib.crc32(low.encode("utf-8", "surrogatepass"), _WORD) % BUCKETS]
    if len(low) > 4:
        out.append(zlib.crc32(low[:4].encode("utf-8", "surrogatepass"), _FOUR) % BUCKETS)
        out.append(zlib.crc32(low[:5].encode("utf-8", "surrogatepass"), _FIVE) % BUCKETS)
    if raw[-1] in MARKS:
        out.append(zlib.crc32(raw[len(raw.rstrip(MARKS)) :][:4].encode(), _TAIL) % BUCKETS)
    if len(core) > 1 and core.isupper():
        out.append(_UPPER % BUCKETS)
    if not core:
        out.append(_SIGN % BUCKETS)
    elif core.isdigit():
        out.append(_DIGIT % BUCKETS)
    return out


AGAIN = zlib.crc32(b"again") % BUCKETS


@dataclasses.dataclass
class Model:
    weights: np.ndarray  # float32, BUCKETS
    thresholds: np.ndarray  # ascending, one less than the grades


class Scores:
    """Scores of texts by the scores of their words, which are kept."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights.tolist()
        self.known = Recent(CACHE_SIZE)

    def _scores(self, words: list[str]) -> list[float]:
        return [sum(map(self.weights.__getitem__, word_features(w))) for w in words]

    def texts(self, texts: pa.Array) -> np.ndarray:
        """Score of each text; each distinct word of a slice is looked up once."""
        out = np.zeros(len(texts))
        for row, buf, offs in slices(texts):
            codes, begin, values, _ = word_codes(buf, offs)
            n = np.diff(begin)
            owner = np.repeat(np.arange(len(n)), n)
            own = np.array(self.known.find(values.to_pylist(), self._scores), dtype=float)[codes]
            again = _again(codes, owner)
            total = np.bincount(owner, own, len(n)) + np.bincount(owner[again], minlength=len(n)) * self.weights[AGAIN]
            out[row : row + len(n)] = SCALE * total / np.maximum(n, 1)
        return out

    def text(self, text: str | None) -> float:
        return float(self.texts(pa.array([text], pa.string()))[0])


def _again(codes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Places of words that repeat the word before them in their text."""
    return np.flatnonzero((codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])) + 1


def features_of(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of one slice of the texts after the other: how many features each text has, these features, and 100 times the number of each
    by the words of its text."""
    for _, buf, offs in slices(texts, FIT_BYTES):
        codes, begin, values, _ = word_codes(buf, offs)
        own = [word_features(w) for w in values.to_pylist()]
        size = np.array([len(x) for x in own], dtype=np.int64)
        pool = np.fromiter((f for x in own for f in x), dtype=np.int64, count=int(size.sum()))
        n_words = np.diff(begin)
        owner = np.repeat(np.arange(len(n_words)), n_words)
        again = owner[_again(codes, owner)]
        ids = np.concatenate([pool[spread((np.cumsum(size) - size)[codes], size[codes])], np.full(len(again), AGAIN)])
        key, n = np.unique(np.concatenate([np.repeat(owner, size[codes]), again]) * BUCKETS + ids, return_counts=True)
        text = key // BUCKETS
        yield np.bincount(text, minlength=len(n_words)), (key % BUCKETS).astype(np.int32), SCALE * n / n_words[text]


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def fit_arrays(texts: list[str | None] | pa.Array, grades: np.ndarray, n_grades: int, rounds: int = ROUNDS) -> Model:
    """Full-batch Adam on the negative log likelihood, weights drawn a little to 0.

    What is held of a feature of a text is 12 bytes; each round goes from slice to slice, so all else is as large as a slice.
    """
    parts = list(features_of(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())))
    common = sum((np.bincount(col, minlength=BUCKETS) for _, col, _ in parts), np.zeros(BUCKETS, dtype=np.int64)) >= MIN_DOCS
    used = np.flatnonzero(common)  # the ridge holds the weights of rare ones small
    number = (np.cumsum(common) - 1).astype(np.int32)
    first_row = 0
    for k, (size, col, val) in enumerate(parts):
        kept = common[col]
        size = np.bincount(np.repeat(np.arange(len(size)), size)[kept], minlength=len(size))
        parts[k] = slice(first_row, first_row := first_row + len(size)), size, number[col[kept]], val[kept]
    n = max(1, len(texts))
    above = grades[:, None] > np.arange(n_grades - 1)[None, :]  # n x thresholds
    share = np.clip(above.mean(axis=0) if len(texts) else np.full(n_grades - 1, 0.5), 0.01, 0.99)
    theta = -np.log(share / (1 - share))
    w = np.zeros(len(used))
    params = [w, theta]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, rounds + 1 if len(set(grades.tolist())) > 1 else 1):
        score = np.zeros(n)
        for rows, size, place, val in parts:
            score[rows] = np.bincount(np.repeat(np.arange(len(size)), size), val * w[place], minlength=len(size))
        up = np.concatenate([np.ones((n, 1)), _sigmoid(score[:, None] - theta[None, :]), np.zeros((n, 1))], axis=1)
        i = np.arange(n)
        p = np.maximum(up[i, grades] - up[i, grades + 1], 1e-9)
        slope = up * (1 - up)  # of each cumulative probability
        d_score = -(slope[i, grades] - slope[i, grades + 1]) / p
        d_theta = np.zeros(n_grades - 1)
        for k in range(n_grades - 1):
            d_theta[k] = (np.where(grades == k + 1, slope[:, k + 1], 0) - np.where(grades == k, slope[:, k + 1], 0)) @ (1 / p)
        d_w = np.zeros(len(used))
        for rows, size, place, val in parts:
            np.add.at(d_w, place, val * np.repeat(d_score[rows], size))
        grad = [d_w / n + RIDGE * w, d_theta / n]
        for p_, g, a, b, rate in zip(params, grad, first, second, (RATE, 0.05)):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            p_ -= rate * (1 - (step - 1) / rounds) * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
        theta[:] = np.maximum.accumulate(theta)
    weights = np.zeros(BUCKETS, dtype=np.float32)
    weights[used] = w
    return Model(weights, theta.copy())


def fit(docs: DataFrame, ratings: DataFrame, n_grades: int, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model:
    """``ratings``: id, grade (0 .. n_grades - 1).  The ``sample`` rated ids that hash smallest are fitted in one task."""
    rated = ratings.select(F.col(id_col).alias("_id"), F.col("grade").cast("int").alias("grade")).where(
        F.col("_id").isNotNull() & F.col("grade").between(0, n_grades - 1)
    )
    rated = rated.orderBy(F.xxhash64("_id"), "_id", "grade").limit(sample)  # a bounded number of short rows
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    both = texts.join(F.broadcast(rated), "_id").groupBy("_id", "grade").agg(F.min("text").alias("text")).select("text", "grade")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        whole = pd.concat(parts) if parts else pd.DataFrame({"text": [], "grade": []})
        whole = whole.assign(text=whole["text"].fillna("")).sort_values(["text", "grade"])
        model = fit_arrays(list(whole["text"]), whole["grade"].to_numpy(dtype=np.int64), n_grades)
        yield pd.DataFrame({"weights": [model.weights.tobytes()], "thresholds": [model.thresholds.tobytes()]})

    row = both.repartition(1).mapInPandas(run, "weights binary, thresholds binary").first()
    if row is None:
        return fit_arrays([], np.zeros(0, dtype=np.int64), n_grades)
    return Model(np.frombuffer(row.weights, dtype=np.float32), np.frombuffer(row.thresholds))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with expected_grade and tail (probability of the top grade)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scores(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache = Scores(shared.value.weights)
        for texts in parts:
            yield pa.array(cache.texts(texts))

    own = free(docs, "score")
    above = [1 / (1 + F.exp(F.lit(float(t)) - F.col(own))) for t in model.thresholds]
    out = docs.withColumn(own, scores(F.col(text_col)))
    return out.select(*others(docs, "expected_grade", "tail"), F.round(sum(above[1:], above[0]), 6).alias("expected_grade"), F.round(above[-1], 6).alias("tail"))


def graded(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Grades of the labels table: 0 toxic, 1 not toxic but without quality, 2 clean.

    Toxic is the lowest: a few words in a hundred make a text toxic, so its score has no fixed place between two thresholds.
    """
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.select(id_col, grade.alias("grade"))


def classify(docs: DataFrame, labels: DataFrame, tail: float = TAIL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with expected_grade, tail and keep."""
    model = fit(docs, graded(labels, id_col), 3, id_col, text_col)
    assert math.isfinite(float(model.weights.sum()))
    out = score(docs, model, text_col)
    return out.select(*others(out, "keep"), (F.col("tail") >= tail).alias("keep"))
