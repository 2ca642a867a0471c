"""Text quality by regularised quadratic discriminant analysis over document statistics."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tierlake.session import materialize

#: Character classes counted, by byte: upper case, lower case, beyond ASCII, digits, white space, marks.
_CLASSES = ("upper", "lower", "wide", "digit", "space", "stop", "bang", "bar", "symbol")
FEATURES = (
    "log_words", "word_length", "word_length_spread", "distinct_words", "top_word", "distinct_lines", "line_words",
    "compressed", *_CLASSES)
_PIECE = 1 << 20  # bytes compressed at once


def _class_table() -> np.ndarray:
    table = np.full(256, _CLASSES.index("symbol"), np.uint8)
    table[128:] = _CLASSES.index("wide")
    for name, chars in (("upper", range(65, 91)), ("lower", range(97, 123)), ("digit", range(48, 58)),
                        ("space", b" \t\n\r\x0b\f"), ("stop", b".,;:"), ("bang", b"!?"), ("bar", b"|")):
        table[list(chars)] = _CLASSES.index(name)
    return table


def _log_share(part: float, whole: float) -> float:
    return math.log((part + 0.5) / (whole + 1.0))


def statistics(text: bytes, table: np.ndarray) -> list[float]:
    """The transformed statistics of one whole text: logs of counts and of shares, so that skewed
    distributions come nearer to normal ones. An empty text has defined values too."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    counts = np.bincount(table[np.frombuffer(text, np.uint8)], minlength=len(_CLASSES))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    repeats = Counter(words)
    packer, packed = zlib.compressobj(1), 0
    for low in range(0, len(text), _PIECE):
        packed += len(packer.compress(text[low:low + _PIECE]))
    packed += len(packer.flush())
    n = len(words)
    return [
        math.log1p(n), math.log1p(lengths.mean() if n else 0), math.log1p(lengths.std() if n else 0),
        _log_share(len(repeats), n), _log_share(max(repeats.values(), default=0), n),
        _log_share(len(set(lines)), len(lines)), math.log1p(n / max(1, len(lines))),
        _log_share(packed, len(text) + 20), *(_log_share(int(c), len(text)) for c in counts)]


def document_statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, features) of every row; null text counts as empty. Other columns are not looked at."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _class_table()
        for batch in batches:
            texts = pc.fill_null(batch.column(1).cast(pa.binary()), b"")
            rows = np.array([statistics(t.as_py(), table) for t in texts], np.float64).reshape(-1, len(FEATURES))
            held = pa.ListArray.from_arrays(
                pa.array(np.arange(0, rows.size + 1, len(FEATURES)), pa.int32()), pa.array(rows.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), held], ["id", "features"])

    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    return source.mapInArrow(run, f"id {source.schema['id'].dataType.simpleString()}, features array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Two normal densities; ``factors`` are the inverted Cholesky factors of their covariances."""

    means: np.ndarray
    factors: np.ndarray
    offsets: np.ndarray

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0, from Mahalanobis distances, priors included."""
        one, zero = (o - 0.5 * np.sum(((rows - m) @ f.T) ** 2, axis=1)
                     for m, f, o in zip(self.means[::-1], self.factors[::-1], self.offsets[::-1]))
        return one - zero


def fit_discriminant(samples: DataFrame, shrinkage: float = 0.1) -> Discriminant | None:
    """Fit on all rows of ``samples(features, label 0 or 1)``; None unless both classes occur.

    Only counts, sums and sums of products are gathered: one bounded row for each class and Arrow
    batch, summed by Spark. Each class covariance is drawn towards the pooled one and its diagonal.
    """
    width = len(FEATURES)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            labels = batch.column(1).to_numpy(zero_copy_only=False)
            for label in (0, 1):
                own = np.column_stack([np.ones(int((labels == label).sum())), rows[labels == label]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([label], pa.int32()), pa.array([(own.T @ own).ravel()])], ["label", "products"])

    partial = samples.select("features", F.col("label").cast("int")).mapInArrow(
        moments, "label int, products array<double>")
    summed = partial.select("label", F.posexplode("products").alias("at", "value")).groupBy("label", "at").agg(
        F.sum("value").alias("value"))
    products = np.zeros((2, (width + 1) ** 2))
    for row in summed.collect():  # (1 + features) ** 2 rows for each class
        products[row["label"], row["at"]] = row["value"]
    products = products.reshape(2, width + 1, width + 1)
    counts = products[:, 0, 0]
    if not counts.all():
        return None
    means = products[:, 0, 1:] / counts[:, None]
    scatter = products[:, 1:, 1:] - counts[:, None, None] * np.einsum("ki,kj->kij", means, means)
    pooled = scatter.sum(axis=0) / counts.sum()
    pooled += np.diag(np.full(width, 1e-6) + 1e-3 * np.diag(pooled))
    factors, offsets = [], []
    for count, own in zip(counts, scatter):
        amount = min(1.0, shrinkage + width / (count + width))  # few rows of a class: nearer to the pooled one
        target = 0.5 * pooled + 0.5 * np.diag(np.diag(pooled))
        lower = np.linalg.cholesky((1 - amount) * own / count + amount * target)
        factors.append(np.linalg.inv(lower))
        offsets.append(math.log(count / counts.sum()) - np.log(np.diag(lower)).sum())
    return Discriminant(means, np.array(factors), np.array(offsets))


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "quality", shrinkage: float = 0.1,
) -> DataFrame:
    """(id, score) of every row of ``docs``: the posterior of label 1, from the text alone.

    ``labels`` holds the rows to learn from, all of them; ids that ``docs`` lacks and null labels
    are passed over, of a pair of id and label one row counts. Without both classes to learn from
    the score is the share of label 1 learnt, or 0.5. Empty and null texts are scored like others.
    """
    rows = materialize(document_statistics(docs, id_column, text_column))
    known = labels.select(F.col(id_column).alias("_id"), F.col(label_column).alias("label")).filter(
        F.col("label").isin(0, 1)).distinct()
    samples = rows.join(known, F.col("id") == F.col("_id")).select("features", "label")
    model = fit_discriminant(samples, shrinkage)
    if model is None:
        share = known.agg(F.avg("label")).first()[0]
        return rows.select("id", F.lit(0.5 if share is None else float(share)).alias("score"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            features = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            odds = np.clip(model.log_odds(features), -500, 500)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-odds)))], ["id", "score"])

    return rows.mapInArrow(score, f"id {rows.schema['id'].dataType.simpleString()}, score double")
