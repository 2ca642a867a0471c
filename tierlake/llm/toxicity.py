"""Toxicity of texts after noisy-channel deobfuscation.

Written forms such as ``1d10t``, ``i.d.i.o.t`` or ``idiooot`` are decoded first: each character of a
suspicious stretch opens a few readings (itself, a letter it stands for, nothing), and Viterbi picks
the reading that a character trigram model of the whole corpus finds likeliest. The restored text
is then scored by word evidence learnt from labelled rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierlake.session import materialize

# Letters that digits and marks stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
#: Costs of readings, in nats: a character as itself is free. A sign that stands for a letter is seldom noise.
SWAP, DROP_SECOND, DROP_REPEAT, DROP_MARK, DROP_SIGN, KEEP_MARK, DROP_GAP, KEEP_GAP = 1.0, 2.0, 0.5, 3.0, 9.0, 6.0, 1.5, 1.5
LETTERS = 63              # commonest letters the language model tells apart; all others are one class
LABELLED = 40_000         # most labelled rows learnt from, those of smallest hash
EVIDENCE = 20_000         # most pieces of evidence kept, the most telling ones
LEAST_DOCUMENTS = 3       # labelled toxic documents a piece of evidence must occur in
REMEMBERED = 100_000      # words of a generation that a task remembers
STEMS = (3, 4, 5, 6, 7)   # lengths of the beginnings that are evidence
_PIECE = 1 << 20          # characters counted at once

_WORDS = re.compile(r"[^\W_]+")
_GAPS = set(" \t._*-")
#: Single characters set apart by gaps, three or more; quotes and brackets may stand before them, marks behind.
_SPACED = re.compile(r"""(?<![^\s"'(\[{])\S(?:[ \t._*-]{1,3}[^\s._*-]){2,}(?![^\s.,;:!?"')\]}])""")
_LEET = "".join(map(re.escape, STANDS_FOR))
_MIXED = re.compile(rf"[{_LEET}*._-]")
_DOUBLE = re.compile(r"(.)\1+")
_TRIPLE = re.compile(r"(.)\1\1")
_BEHIND = ".,;:!?\"')]}"
_QUOTES = "\"'[{"
_TAIL = re.compile(r"([^\w\s])\1+$")


@dataclass(frozen=True)
class LanguageModel:
    """Costs of character trigrams; class 0 is the gap between words, the last one any other letter."""

    letters: str
    costs: np.ndarray

    @cached_property
    def span(self) -> float:
        """What the dearest trigram costs more than the cheapest one."""
        return float(self.costs.max()) - float(self.costs.min())

    def code(self, char: str) -> int:
        return self.letters.find(char) + 1 or (len(self.letters) + 1 if char.isalpha() else 0)


def letter_counts(docs: DataFrame) -> list[str]:
    """The commonest letters of all of ``docs(text)``, lower-cased, in falling order."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = np.zeros(0x110000, np.int64)
            for text in batch.column(0):
                text = (text.as_py() or "").lower()
                for low in range(0, len(text), _PIECE):
                    points = np.frombuffer(text[low:low + _PIECE].encode("utf-32-le"), np.uint32)
                    found = np.bincount(points)
                    total[:len(found)] += found
            kept = [int(c) for c in np.nonzero(total)[0] if chr(c).isalpha()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(map(chr, kept)), pa.string()), pa.array(total[kept])], ["c", "n"])

    totals = docs.select("text").mapInArrow(count, "c string, n long").groupBy("c").agg(F.sum("n").alias("n"))
    return [r["c"] for r in totals.orderBy(F.desc("n"), "c").limit(LETTERS).collect()]


@lru_cache(maxsize=2)
def _class_table(letters: str) -> np.ndarray:
    """By code point: the letter's place from 1 on, one class for all other letters, else 0."""
    table = np.array([chr(point).isalpha() for point in range(0x110000)], np.uint8) * np.uint8(len(letters) + 1)
    table[list(map(ord, letters))] = range(1, len(letters) + 1)
    return table


def fit_language_model(docs: DataFrame) -> LanguageModel:
    """Trigram costs over every character of ``docs(text)``; what is gathered is bounded by the letters."""
    letters = "".join(letter_counts(docs))
    size = len(letters) + 2

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _class_table(letters)
        for batch in batches:
            total = np.zeros(size ** 3, np.int64)
            for text in batch.column(0):
                text = f"  {(text.as_py() or '').lower()} "
                for low in range(0, len(text) - 2, _PIECE):
                    points = np.frombuffer(text[low:low + _PIECE + 2].encode("utf-32-le"), np.uint32)
                    codes = table[points].astype(np.int64)
                    codes = codes[np.append(True, (codes[1:] > 0) | (codes[:-1] > 0))]
                    found = np.bincount((codes[:-2] * size + codes[1:-1]) * size + codes[2:])
                    total[:len(found)] += found
            seen = np.nonzero(total)[0]
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["at", "n"])

    totals = docs.select("text").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    counts = np.zeros(size ** 3)
    for row in totals.collect():  # at most (letters + 2) ** 3 rows
        counts[row["at"]] = row["n"]
    counts = counts.reshape(size, size, size)
    unigram = (counts.sum(axis=(0, 1)) + 1) / (counts.sum() + size)
    pairs = counts.sum(axis=0)
    bigram = (pairs + 10 * unigram) / (pairs.sum(axis=1, keepdims=True) + 10)
    trigram = (counts + 10 * bigram[None]) / (counts.sum(axis=2, keepdims=True) + 10)
    return LanguageModel(letters, -np.log(trigram))


def _readings(char: str, same: int) -> list[tuple[str, float]]:
    """What a character may mean; ``same`` counts the equal ones just before it."""
    again = [("", DROP_SECOND if same == 1 else DROP_REPEAT)] if same else []
    if char.isalpha():
        return [(char, 0.0)] + again
    if char.isspace():
        return [(" ", KEEP_GAP), ("", DROP_GAP)]
    read = [(letter, SWAP) for letter in STANDS_FOR.get(char, "")]
    return read + again + [(" ", KEEP_MARK), ("", DROP_SIGN if char in STANDS_FOR else DROP_MARK)]


def decode(stretch: str, model: LanguageModel) -> str:
    """The likeliest reading of an obfuscated stretch, lower-cased; equal costs keep the earlier reading.

    Viterbi over states of the last two characters read. A state is given up only where no onward
    reading can make it the best: two states that read the same on differ in their next two costs alone.
    """
    cost_of = model.costs.item
    codes = {" ": 0}
    reach = 2 * model.span + DROP_GAP
    paths: dict[tuple[str, str], tuple[float, tuple]] = {(" ", " "): (0.0, ())}
    before, same = "", 0
    for char in stretch.lower():
        same = same + 1 if char == before else 0
        before = char
        options = _readings(char, same)
        for letter, _ in options:
            if letter and letter not in codes:
                codes[letter] = model.code(letter)
        after: dict[tuple[str, str], tuple[float, tuple]] = {}
        for (a, b), (cost, trail) in paths.items():
            for letter, extra in options:
                if not letter or (letter == " " and b == " "):
                    state, total, onward = (a, b), cost + extra, trail
                else:
                    state = (b, letter)
                    total = cost + extra + cost_of(codes[a], codes[b], codes[letter])
                    onward = (trail, letter)
                if state not in after or total < after[state][0]:
                    after[state] = (total, onward)
        if len(after) > 8:
            limit = min(c for c, _ in after.values()) + reach
            after = {state: path for state, path in after.items() if path[0] <= limit}
        paths = after
    _, trail = min(((c + cost_of(codes[a], codes[b], 0), t) for (a, b), (c, t) in paths.items()), key=lambda p: p[0])
    read = []
    while trail:
        trail, letter = trail
        read.append(letter)
    return "".join(reversed(read)).strip()


def _core(token: str) -> str:
    """The token without quotes and brackets before it, and without marks, one of them repeated or not, behind it."""
    return _TAIL.sub("", token.lstrip("\"'([{").rstrip(_BEHIND))


def _cores(token: str) -> list[str]:
    """The token's core, and the one with a leading ``(`` that may stand for a letter."""
    core, opened = _core(token), token.lstrip(_QUOTES)
    return [core, "(" + core] if core and opened.startswith("(") else [core]


def _suspicious(core: str) -> bool:
    """A letter along with a mark or digit, or with a character three times in a row."""
    return any(map(str.isalpha, core)) and bool(_MIXED.search(core) or _TRIPLE.search(core))


def _squeezed(word: str) -> str:
    return _DOUBLE.sub(r"\1", word)


class Restorer:
    """Words of whole texts after decoding.

    A plain word with a doubled letter, as many are, is decoded only if it may hide evidence: if without
    the repeats it begins as a word of ``telling`` does without its own. With None all of them are decoded.
    """

    def __init__(self, model: LanguageModel, telling: frozenset[str] | None = None):
        self.model, self.known = model, {}
        self.hidden = None if telling is None else frozenset(map(_squeezed, telling))
        self.lengths = sorted({len(word) for word in self.hidden or () if len(word) > 1})

    def doubled(self, core: str) -> bool:
        if not _DOUBLE.search(core) or not core.isalpha():
            return False
        if self.hidden is None:
            return True
        word = _squeezed(core)
        for k in self.lengths:
            if k > len(word):
                break
            if word[:k] in self.hidden:
                return True
        return False

    def read(self, token: str) -> tuple[str, ...]:
        plain = token.lstrip(_QUOTES).rstrip(_BEHIND)
        if plain.isalpha() and not (_DOUBLE.search(plain) and (_TRIPLE.search(plain) or self.doubled(plain))):
            return (plain,)  # most tokens
        words = _WORDS.findall(token)
        for core in _cores(token):
            if _suspicious(core) or self.doubled(core):
                words += self.stretch(core)
        return tuple(dict.fromkeys(w for w in words if not w.isdigit()))

    def token(self, token: str) -> tuple[str, ...]:
        found = self.known.get(token)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = self.known[token] = self.read(token)
        return found

    def stretch(self, text: str) -> list[str]:
        return _WORDS.findall(decode(text, self.model))

    def spaced(self, text: str) -> list[str]:
        """Words read from stretches of single characters."""
        return [word for found in _SPACED.finditer(text) if len(set(found[0]) - _GAPS) > 1 for word in self.stretch(found[0])]

    def words(self, text: str) -> set[str]:
        """Distinct words of the whole text, as written and as decoded."""
        text = text.lower()
        found = set(self.spaced(text))
        for token in set(text.split()):
            found.update(self.token(token))
        return found


class Weigher(dict):
    """The weight of the most telling evidence in a token, remembered in two generations of words."""

    def __init__(self, language: LanguageModel, weights: dict[str, float]):
        super().__init__()
        self.restorer = Restorer(language, frozenset(e.rstrip("*") for e in weights))
        self.weights, self.openings = weights, {e.rstrip("*")[:3] for e in weights}
        stems = {e[:-1]: w for e, w in weights.items() if e.endswith("*")}
        # the largest weight of a stem and of those it begins with
        self.stems = {s: max(stems.get(s[:k], 0.0) for k in range(1, len(s) + 1)) for s in stems}
        self.older: dict[str, float] = {}

    def __missing__(self, token: str) -> float:
        found = self.older.get(token)
        if found is None:
            plain = token.lstrip(_QUOTES).rstrip(_BEHIND)
            if plain.isalpha() and not _DOUBLE.search(plain):
                found = self.word(plain)  # most tokens
            else:
                found = max(map(self.word, self.restorer.read(token)), default=0.0)
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[token] = found
        return found

    def word(self, word: str) -> float:
        """The largest weight of what ``evidence_of`` gives."""
        if word[:3] not in self.openings:
            return 0.0
        found = self.weights.get(word, 0.0)
        for k in range(min(STEMS[-1], len(word) - 1), STEMS[0] - 1, -1):
            stem = self.stems.get(word[:k])
            if stem is not None:
                return max(found, stem)
        return found

    def signals(self, text: str) -> list[float]:
        """What the score is made from: sums, counts and the largest of the weights, and the text's length."""
        text = text.lower()
        tokens = text.split()
        found = [w for w in map(self.__getitem__, set(tokens)) if w]
        found += [w for w in map(self.word, set(self.restorer.spaced(text))) if w]
        total, n = sum(sorted(found)), len(found)
        return [1.0, total / 5, np.log1p(total), np.log1p(len(tokens)), max(found, default=0.0), np.log1p(n),
                total / np.sqrt(len(tokens) + 1)]


def evidence_of(word: str) -> list[str]:
    """A word stands for itself and for words with the same beginning."""
    return [word] + [word[:k] + "*" for k in STEMS if len(word) > k]


def _fit_logistic(rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Newton's method with a ridge; the ridge keeps separable rows finite."""
    weights = np.zeros(rows.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        bend = (rows * (p * (1 - p))[:, None]).T @ rows + 0.1 * np.eye(len(weights))
        step = np.linalg.solve(bend, rows.T @ (labels - p) - 0.1 * weights)
        weights = weights + step
        if np.abs(step).max() < 1e-9:
            break
    return weights


def _count_evidence(samples: DataFrame, model: LanguageModel) -> DataFrame:
    """(e, half, toxic, other): in how many rows of ``samples(text, label, half)`` evidence occurs; '' in all."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model, frozenset())
        for batch in batches:
            seen: dict[tuple[int, int], Counter] = {}
            for text, label, half in zip(batch.column(0), *(batch.column(k).to_pylist() for k in (1, 2))):
                words = restorer.words(text.as_py() or "")
                found = {""}.union(words, *({w[:k] + "*" for w in words if len(w) > k} for k in STEMS))
                seen.setdefault((half, label), Counter()).update(found)
            for (half, label), counts in seen.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(counts), pa.string()), pa.array([half] * len(counts), pa.int32()),
                     pa.array([label] * len(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())],
                    ["e", "half", "label", "n"])

    found = samples.select("text", "label", "half").mapInArrow(count, "e string, half int, label int, n long")
    return found.groupBy("e", "half").agg(
        F.coalesce(F.sum(F.when(F.col("label") == 1, F.col("n"))), F.lit(0)).alias("toxic"),
        F.coalesce(F.sum(F.when(F.col("label") == 0, F.col("n"))), F.lit(0)).alias("other"))


def _weigh(counts: DataFrame) -> dict[str, float]:
    """Log ratios of document frequencies in toxic and other rows, for what is telling."""
    base = counts.filter("e = ''").first()
    if base is None or not base["toxic"] or not base["other"]:
        return {}
    t, o = float(base["toxic"]), float(base["other"])
    weight = F.log((F.col("toxic") + 0.5) / (t + 1)) - F.log((F.col("other") + 0.5) / (o + 1))
    share = (F.col("toxic") + F.col("other")) / (t + o)
    z = (F.col("toxic") / t - F.col("other") / o) / F.sqrt(share * (1 - share) * (1 / t + 1 / o) + 1e-12)
    telling = counts.filter(F.col("toxic") >= LEAST_DOCUMENTS).select("e", weight.alias("w"), z.alias("z")).filter(
        "w > 0.7 AND z > 4 AND e <> ''")
    return {r["e"]: r["w"] for r in telling.orderBy(F.desc("z"), "e").limit(EVIDENCE).collect()}


@dataclass(frozen=True)
class ToxicityModel:
    """What scoring needs; ``fitted`` is None where there was too little to learn from, see ``share``."""

    language: LanguageModel
    weights: dict[str, float]
    fitted: np.ndarray | None
    share: float

    def scores(self, texts: pa.Array, weigher: Weigher) -> np.ndarray:
        if self.fitted is None:
            return np.full(len(texts), self.share)
        rows = np.array([weigher.signals(t.as_py() or "") for t in texts]).reshape(-1, len(self.fitted))
        return 1 / (1 + np.exp(-np.clip(rows @ self.fitted, -500, 500)))

    def weigher(self) -> Weigher:
        return Weigher(self.language, self.weights)


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "toxic", labelled: int = LABELLED,
) -> ToxicityModel:
    """Learn from ``labels``; the language model counts every character of ``docs``.

    At most ``labelled`` rows of ``labels`` are used, to weigh the evidence and to fit how its sum
    becomes a score (with weights from the other half of the rows, so that the fit isn't too sure).
    Null ids and labels and ids that ``docs`` lacks are passed over; of an id's labels the largest
    counts. Without rows of both labels every score will be the share of label 1 learnt, or 0.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    known = labels.select(F.col(id_column).alias("_id"), F.col(label_column).alias("label")).filter(
        F.col("label").isin(0, 1) & F.col("_id").isNotNull()).groupBy("_id").agg(F.max("label").alias("label"))
    chosen = known.withColumn("part", F.xxhash64("_id", F.lit("part"))).orderBy("part", "_id").limit(labelled)
    samples = materialize(rows.join(chosen, F.col("id") == F.col("_id")).select(
        "text", F.col("label").cast("int").alias("label"), F.pmod("part", F.lit(2)).cast("int").alias("half")))
    language = fit_language_model(rows)
    counts = materialize(_count_evidence(samples, language))
    both = counts.groupBy("e").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    weights = _weigh(both)
    halves = [_weigh(counts.filter(F.col("half") == 1 - half)) for half in (0, 1)]  # learnt on the other half

    def signals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weighers = [Weigher(language, w) for w in halves]
        for batch in batches:
            found = [weighers[half].signals(text.as_py() or "")
                     for text, half in zip(batch.column(0), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.float64()))], ["label", "x"])

    # at most `labelled` rows of seven numbers
    pairs = samples.mapInArrow(signals, "label int, x array<double>").collect() if weights else []
    seen = np.array([r["label"] for r in pairs])
    if len(set(seen.tolist())) < 2:
        return ToxicityModel(language, weights, None, float(samples.agg(F.avg("label")).first()[0] or 0))
    return ToxicityModel(language, weights, _fit_logistic(np.array([r["x"] for r in pairs]), seen), 0.0)


def toxicity_scores(docs: DataFrame, model: ToxicityModel, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, score) of every row of ``docs``: how likely label 1 is, from the whole text alone.

    Null and empty texts are scored like others; repeated rows alike. Other columns are not looked at.
    """
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigher = model.weigher()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.scores(batch.column(1), weigher))], ["id", "score"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(score, f"id {rows.schema['id'].dataType.simpleString()}, score double")


def without_toxic(docs: DataFrame, model: ToxicityModel, text_column: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``."""
    at = docs.columns.index(text_column)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigher = model.weigher()
        for batch in batches:
            yield batch.filter(pa.array(model.scores(batch.column(at), weigher) < threshold, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
