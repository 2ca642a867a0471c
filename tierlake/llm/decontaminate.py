"""Benchmark decontamination: short test items found inside long documents.

An item's shingles are hashed, and its sketch is the few smallest of them. Items are partitioned by
size: the sketch of an item with n shingles has one more than may be missing at the containment
threshold, so a document that contains the item has at least one of the sketch. Documents are
searched for sketch hashes as a whole; what is found is verified by counting exact shingles.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

WIDTH = 5
THRESHOLD = 0.8
ITEM_CHARS = 8 << 20   # characters of items that are broadcast at once; more take further passes
_WORDS = re.compile(r"\w+")
_STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                   0xFF51AFD7ED558CCD], np.uint64)


def words_of(text: str | None) -> list[str]:
    """Runs of letters, digits and underscores, lower-cased."""
    return _WORDS.findall((text or "").lower())


def needed(shingles: int, threshold: float) -> int:
    """Fewest shared shingles that make a containment of at least ``threshold``."""
    return max(1, math.ceil(round(threshold * shingles, 9)))


def _shingle_hashes(words: list[str], width: int) -> np.ndarray:
    """A hash for each run of ``width`` words; equal within one Python process only."""
    if len(words) < width:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    count = len(words) - width + 1
    mixed = np.zeros(count, np.uint64)
    for at in range(width):
        mixed = (mixed ^ own[at:at + count]) * _STEPS[at % len(_STEPS)]
        mixed ^= mixed >> np.uint64(29)
    return mixed


def shingles(words: list[str], width: int) -> set[tuple[str, ...]]:
    return {tuple(words[at:at + width]) for at in range(len(words) - width + 1)}


class ContainmentIndex:
    """Sketches of items, by shingle width: items with fewer words than a shingle are one shingle."""

    def __init__(self, items: list[tuple[object, str]], width: int, threshold: float):
        self.threshold = threshold
        self.items: list[tuple[object, int, set]] = []  # id, width, shingles
        sketches: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for key, text in items:
            words = words_of(text)
            if not words:
                continue
            own = min(width, len(words))
            exact = shingles(words, own)
            missing = len(exact) - needed(len(exact), threshold)
            for value in np.unique(_shingle_hashes(words, own))[:missing + 1].tolist():
                sketches[own][value].append(len(self.items))
            self.items.append((key, own, exact))
        self.sketches = sketches
        self.values = {w: np.array(sorted(s), np.uint64) for w, s in sketches.items()}

    def search(self, text: str | None) -> Iterator[tuple[object, int, int]]:
        """(item, its shingles, how many of them the text has) at or above the threshold."""
        words, found = words_of(text), set()
        for width, values in self.values.items():
            own = _shingle_hashes(words, width)
            near = values[np.minimum(np.searchsorted(values, own), len(values) - 1)] == own
            for value in set(own[near].tolist()):
                found.update(self.sketches[width][value])
        exact: dict[int, set] = {}
        for at in sorted(found):
            key, width, wanted = self.items[at]
            if width not in exact:
                exact[width] = shingles(words, width)
            shared = len(wanted & exact[width])
            if shared >= needed(len(wanted), self.threshold):
                yield key, len(wanted), shared


def _passes(items: DataFrame, id_column: str, text_column: str, chars: int) -> Iterator[list[tuple[object, str]]]:
    """Distinct items in portions of bounded size."""
    distinct = items.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")).filter(
        "text IS NOT NULL").distinct()
    total = distinct.agg(F.sum(F.length("text"))).first()[0] or 0
    passes = max(1, -(-total // chars))
    for part in range(passes):
        rows = distinct.filter(F.pmod(F.xxhash64("id", "text"), F.lit(passes)) == part)
        yield [(r["id"], r["text"]) for r in rows.collect()]


def find_leaks(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text_column: str = "text", width: int = WIDTH, threshold: float = THRESHOLD,
    item_chars: int = ITEM_CHARS,
) -> DataFrame:
    """(id, item, item_shingles, shared, containment): items that at least ``threshold`` of is in a document.

    Shingles are distinct runs of ``width`` words. Items are broadcast in passes of bounded size,
    each of which scans the documents once and moves none. Null and empty texts on either side
    match nothing; an item of fewer words is one shingle. Repeated document rows give repeated rows,
    repeated item rows count once.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kinds = (source.schema["id"].dataType.simpleString(), items.schema[item_column].dataType.simpleString())
    schema = f"id {kinds[0]}, item {kinds[1]}, item_shingles long, shared long, containment double"
    found = None
    for part in _passes(items, item_column, item_text_column, item_chars):
        shared = spark.sparkContext.broadcast(part)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = ContainmentIndex(shared.value, width, threshold)
            for batch in batches:
                hits = [(row, *hit) for row, text in enumerate(batch.column(1)) for hit in index.search(text.as_py())]
                if hits:
                    at, keys, sizes, counts = map(list, zip(*hits))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(at)), pa.array(keys), pa.array(sizes, pa.int64()),
                         pa.array(counts, pa.int64()), pa.array(np.array(counts) / np.array(sizes))],
                        ["id", "item", "item_shingles", "shared", "containment"])

        rows = source.mapInArrow(search, schema)
        found = rows if found is None else found.unionAll(rows)
    return found


def without_leaks(
    docs: DataFrame, items: DataFrame, text_column: str = "text", item_column: str = "item_id",
    item_text_column: str = "text", width: int = WIDTH, threshold: float = THRESHOLD, item_chars: int = ITEM_CHARS,
) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no item; see ``find_leaks``."""
    spark, at = docs.sparkSession, docs.columns.index(text_column)
    for part in _passes(items, item_column, item_text_column, item_chars):
        shared = spark.sparkContext.broadcast(part)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = ContainmentIndex(shared.value, width, threshold)
            for batch in batches:
                keep = [next(index.search(t.as_py()), None) is None for t in batch.column(at)]
                yield batch.filter(pa.array(keep, pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
