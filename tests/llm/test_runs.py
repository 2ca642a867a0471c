import hashlib
import random
from fractions import Fraction
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tierlake.llm.queries import CHECKS
from tierlake.llm.runs import RunCatcher, collapse, find_runs, runs_of


def brute_runs(words, least_length=24, least_exponent=3):
    least = {}
    for period in range(1, len(words) // least_exponent + 1):
        start = 0
        for i in range(period, len(words) + 1):
            if i == len(words) or words[i] != words[i - period]:
                if i - start >= max(least_length, least_exponent * period):
                    least.setdefault((start, i), period)
                start = i - period + 1
    return sorted((start, end - start, period) for (start, end), period in least.items())


def planted(seed):
    chance = random.Random(seed)
    words = []
    while len(words) < chance.randrange(1, 400):
        unit = [chance.randrange(chance.choice((2, 3, 50))) for _ in range(chance.randrange(1, 30))]
        words += (unit * chance.randrange(1, 8))[:chance.randrange(1, 200)]
    return words


@pytest.mark.parametrize("seed", range(60))
def test_runs_are_those_of_every_period(seed):
    words = planted(seed)
    assert runs_of(words) == brute_runs(words)
    assert runs_of(words, 2, 2) == brute_runs(words, 2, 2)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=120))
def test_squares_of_two_letters(words):
    assert runs_of(words, 2, 2) == brute_runs(words, 2, 2)


@pytest.mark.parametrize("step", [1, 2, 7, 64])
def test_appending_bit_by_bit_gives_the_same(step):
    words = planted(5) + planted(6) + [1, 2] * 40
    catcher = RunCatcher()
    for low in range(0, len(words), step):
        catcher.append(np.array(words[low:low + step]))
        known = words[:low + step]
        if low % 50 < step:
            assert catcher.runs() == brute_runs(known)
    assert catcher.runs() == brute_runs(words)


def test_long_texts_of_one_word_and_of_a_long_period():
    assert runs_of(["a"] * 100_000) == [(0, 100_000, 1)]
    unit = list(range(40_000))
    assert runs_of([-1, *unit, *unit, *unit, -2]) == [(1, 120_000, 40_000)]


def test_equal_hashes_of_different_words_are_found_out(monkeypatch):
    import tierlake.llm.runs as module
    monkeypatch.setattr(module, "_MIX", np.uint64(0))  # every word hashes alike
    words = [1, 2, 3, 4] * 9 + list(range(30))
    assert runs_of(words) == brute_runs(words)


def test_nulls_empty_texts_repeats_and_other_columns(spark):
    rows = [(1, "a b " * 20, 7), (1, "a b " * 20, 7), (None, None, 1), (2, "", 2), (3, "  \t\n ", 3), (4, "x y " * 30, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    found = sorted(map(tuple, find_runs(docs).collect()), key=repr)
    assert [r[:2] for r in found] == [(1, 40), (1, 40), (2, 0), (3, 0), (4, 1), (None, 0)]
    assert [tuple(r) for r in found[0][2]] == [(0, 40, 2)] and found[0][3] == "a b"
    assert found[2][3] == "" and found[5][3] == ""
    assert find_runs(docs.limit(0)).collect() == []


def expected(doc_id, text):
    words, h = (text or "").encode().split(), crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    own = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    return (doc_id, len(runs), *own, hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(b" ".join(collapse(words, runs))).hexdigest())


def test_query_against_brute_force(spark, tmp_path):
    chance = random.Random(1)
    rows = [(i, " ".join(chance.choice("abcdefghij") for _ in range(chance.randrange(0, 150)))) for i in range(300)]
    rows += [(300, None), (301, "one two " * 30 + "é " * 25)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    found = CHECKS["op13_run_detection"].run(spark, str(tmp_path)).select(columns).collect()
    assert sorted(map(tuple, found)) == sorted(expected(*row) for row in rows)
    assert sum(r["n_runs"] > 0 for r in found) > 10
