"""Periodic runs of words, caught online by dyadic squares.

A sequence grows by appended words. At each level k the blocks of 2**k words that end up complete
become catchers: a catcher waits for its own words to come again 2 * 2**k to 4 * 2**k words later
(1 to 3 words at level 0). Every window that an appended word completes is so compared with two
catchers at each level. A hit proposes a period, and the common suffix and prefix comparisons around
it give the whole stretch with that period. Stretches that reach the end of what is known stay open
and advance with each appended word; a stretch of twice its period is a square, overlapping squares
of a period are the same stretch, and a long enough stretch is a run.

No run is missed: within the first period q of a run there is an aligned block of 2**k words, with
2 * 2**k <= q < 4 * 2**k, and it comes again q words later. Windows are compared by polynomial
hashes, equal windows always agree; every stretch found is then compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Words are what stands between these; regular expression of the words themselves.
WORD = r"[^\x20\x09-\x0D]+"
LEAST_LENGTH, LEAST_EXPONENT = 24, 3
_AT_ONCE = 1 << 15      # words appended in one step, a bound on memory
_LONG = 16              # periods from which a stretch spares its multiples the comparison
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_STEP, _BACK = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))


class RunCatcher:
    """Runs of a growing sequence of integer codes.

    ``append`` may get one code or many; ``runs`` tells those known so far. With a least exponent of 2
    and a least length of 2 every square counts. Memory is some 40 bytes a word plus a bounded step.
    """

    def __init__(self, least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT):
        if least_exponent < 2:
            raise ValueError("a run has at least two periods")
        self.least_length, self.least_exponent = least_length, least_exponent
        self.n = 0
        self._words = np.zeros(64, np.int64)
        self._sums = np.zeros(65, np.uint64)     # of word hashes times powers of the base
        self._backs = np.zeros(65, np.uint64)    # powers of the base's inverse
        self._backs[0] = 1
        self._power = np.uint64(1)               # power of the base at the end
        self._found: dict[tuple[int, int], int] = {}   # (period, start) to end
        self._open: dict[int, int] = {}                # period to start, of stretches at the end

    def append(self, codes: np.ndarray) -> None:
        codes = np.asarray(codes, np.int64)
        for low in range(0, len(codes), _AT_ONCE):
            self._step(codes[low:low + _AT_ONCE])

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of the runs so far, by start; each with its smallest period."""
        least: dict[tuple[int, int], int] = {}
        for (period, start), end in self._found.items():
            if end - start >= self._needed(period):
                least[start, end] = min(period, least.get((start, end), period))
        return sorted((start, end - start, period) for (start, end), period in least.items())

    def _needed(self, period):
        return np.maximum(self.least_length, self.least_exponent * period)

    def _step(self, codes: np.ndarray) -> None:
        if not len(codes):
            return
        old, new = self.n, self.n + len(codes)
        self._grow(new)
        self._words[old:new] = codes
        values = (codes.astype(np.uint64) + np.uint64(1)) * _MIX
        values ^= values >> np.uint64(29)
        powers = np.cumprod(np.concatenate(([self._power], np.full(len(codes), _STEP))))
        self._sums[old + 1:new + 1] = self._sums[old] + np.cumsum(values * powers[:-1])
        self._power = powers[-1]
        self._backs[old:new + 1] = np.cumprod(np.concatenate(([self._backs[old]], np.full(len(codes), _BACK))))
        self.n = new
        self._advance(old, new)
        starts, periods = self._hits(old, new)
        if len(starts):
            self._extend(starts, periods)

    def _grow(self, size: int) -> None:
        if size > len(self._words):
            room = max(size, 2 * len(self._words))
            self._words = np.concatenate((self._words, np.zeros(room - len(self._words), np.int64)))
            self._sums = np.concatenate((self._sums, np.zeros(room + 1 - len(self._sums), np.uint64)))
            self._backs = np.concatenate((self._backs, np.zeros(room + 1 - len(self._backs), np.uint64)))

    def _advance(self, old: int, new: int) -> None:
        """Open stretches go on until the first appended word that differs from the one a period before."""
        words = self._words
        for period, start in list(self._open.items()):
            differs = np.flatnonzero(words[old:new] != words[old - period:new - period])
            end = old + int(differs[0]) if len(differs) else new
            if len(differs):
                del self._open[period]
            if end < new and end - start < self._needed(period):
                self._found.pop((period, start), None)
            else:
                self._found[period, start] = end

    def _hashes(self, low: int, high: int, size: int) -> np.ndarray:
        """Of the windows of ``size`` words that begin at ``low`` to ``high`` - 1."""
        return (self._sums[low + size:high + size] - self._sums[low:high]) * self._backs[low:high]

    def _hits(self, old: int, new: int) -> tuple[np.ndarray, np.ndarray]:
        """Catchers whose words the windows completed between ``old`` and ``new`` repeat: (places, periods)."""
        found = []
        long = [(p, s, e) for (p, s), e in self._found.items() if e - s >= _LONG * p]
        level = 0
        while 3 << level <= new or level == 0:
            size = 1 << level
            first, stop = max(old - size + 1, 0), new - size + 1
            base = max(first - 4 * size, 0)
            if stop <= first:
                break
            hashes = self._hashes(base, stop, size)
            at = np.arange(first, stop)
            own = hashes[first - base:]
            for back in ((1, 2, 3) if level == 0 else (2, 3)):
                catcher = at - back if level == 0 else ((at >> level) - back) << level
                skip = int(np.searchsorted(catcher, 0))  # catchers never fall
                hit = np.flatnonzero(own[skip:] == hashes[catcher[skip:] - base]) + skip
                if len(hit):
                    places, periods = catcher[hit], at[hit] - catcher[hit]
                    for p, s, e in long:  # multiples of a known period within its stretch tell nothing new
                        known = (periods % p == 0) & (places >= s) & (places + periods + size <= e)
                        places, periods = places[~known], periods[~known]
                    if len(places) > 4 * _LONG:  # maybe a long stretch, which spares the levels above
                        self._extend(places, periods)
                        long = [(p, s, e) for (p, s), e in self._found.items() if e - s >= _LONG * p]
                    else:
                        found.append((places, periods))
            level += 1
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _extend(self, places: np.ndarray, periods: np.ndarray) -> None:
        """Whole stretches around hits; those long enough, and those at the end, are kept."""
        right = self._common(places, periods, forward=True)
        left = self._common(places, periods, forward=False)
        start, end = places - left, places + right + periods
        kept = (end - start >= self._needed(periods)) | (end == self.n)
        if not kept.any():
            return
        pairs = np.unique(np.stack((periods[kept], start[kept], end[kept])), axis=1)
        for period, begin, stop in pairs.T.tolist():
            if (period, begin) in self._found and self._found[period, begin] >= stop:
                continue
            if np.array_equal(self._words[begin:stop - period], self._words[begin + period:stop]):
                self._keep(period, begin, stop)
            else:  # equal hashes of different words: compare all words at this distance
                same = np.concatenate(([False], self._words[:self.n - period] == self._words[period:self.n], [False]))
                edges = np.flatnonzero(same[1:] != same[:-1])
                for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
                    if b + period - a >= self._needed(period) or b + period == self.n:
                        self._keep(period, a, b + period)

    def _keep(self, period: int, start: int, end: int) -> None:
        self._found[period, start] = end
        if end == self.n:
            self._open[period] = start

    def _common(self, places: np.ndarray, periods: np.ndarray, forward: bool) -> np.ndarray:
        """How many words from ``places`` on, or before them, equal those a period later."""
        done = np.zeros(len(places), np.int64)
        step = 1 << max(self.n.bit_length() - 1, 0)
        while step:
            low = places + done if forward else places - done - step
            fits = (low >= 0) & (low + periods + step <= self.n)
            a = np.where(fits, low, 0)
            b = np.where(fits, low + periods, 0)
            size = np.where(fits, step, 0)
            same = (self._sums[a + size] - self._sums[a]) * self._backs[a] == (self._sums[b + size] - self._sums[b]) * self._backs[b]
            done += np.where(fits & same, step, 0)
            step >>= 1
        return done


def runs_of(words: list, least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``words``."""
    if len(words) < least_length:
        return []
    codes: dict = {}
    catcher = RunCatcher(least_length, least_exponent)
    catcher.append(np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words)))
    return catcher.runs()


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that stand in no run after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def find_runs(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT,
) -> DataFrame:
    """(id, n_words, runs, collapsed) of every row of ``docs``, without a shuffle.

    ``runs`` are the maximal stretches of consecutive words with a smallest period q and a length of
    at least ``least_length`` and ``least_exponent`` * q, as structs of start (word number from 0), length and
    period, by start and period. ``collapsed`` has the words outside of runs and those of each run's first
    period, joined by single spaces. Null and empty texts have no words, no runs and an empty
    ``collapsed``. Each row is looked at by itself: repeated rows fare alike, null ids stay, other
    columns are not read. A text is held by one task, whatever its length.
    """
    row = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, runs, texts = [], [], []
            for text in batch.column(1).cast(pa.binary()):
                words = (text.as_py() or b"").split()  # ASCII white space alone, as WORD has it
                found = runs_of(words, least_length, least_exponent)
                counts.append(len(words))
                runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
                texts.append(b" ".join(collapse(words, found)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(runs, pa.list_(row)),
                 pa.array(texts, pa.binary()).cast(pa.string())], ["id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(
        run, f"id {rows.schema['id'].dataType.simpleString()}, n_words long, "
             "runs array<struct<start:long,length:long,period:long>>, collapsed string")


def strongest(runs: Column) -> Column:
    """The run of greatest length over period, compared exactly; of equals the first; null without runs."""
    return F.aggregate(F.slice(runs, 2, F.greatest(F.size(runs), F.lit(1))), F.get(runs, F.lit(0)), lambda best, r: F.when(
        r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def with_planted_run(text: Column, seed: Column) -> Column:
    """The words of ``text``, a periodic tail put in where ``seed`` mod 10 is 0; other texts stay as they are.

    With n words, g = seed div 10, a = g mod n and p = 1 + (n - a) div (3 + g mod 8) every word i >= a
    becomes word a + (i - a) mod p.
    """
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    g = F.floor(seed / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    planted = F.concat(F.slice(words, F.lit(1), a), tail)
    return F.when((seed % 10 == 0) & (n > 0), F.array_join(planted, " ")).otherwise(text)
