import hashlib
import random

import numpy as np
import pytest

import tierlake.llm.repeats as module
from tierlake.llm.queries import CHECKS
from tierlake.llm.repeats import without_repeats


def brute(rows, length):
    """(id, kept, n_bytes, spans) by a dictionary of all strings."""
    first, rank = {}, lambda i: () if i is None else (i,)
    for doc_id, text in rows:
        data = (text or "").encode()
        for k in range(len(data) - length + 1):
            place = (rank(doc_id), k)
            first[data[k:k + length]] = min(first.get(data[k:k + length], place), place)
    found = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for k in range(len(data) - length + 1):
            if first[data[k:k + length]] < (rank(doc_id), k):
                gone[k:k + length] = True
        edges = np.flatnonzero(np.diff(np.append(False, gone)))
        found.append((doc_id, bytes(b for b, g in zip(data, gone) if not g), len(data), list(zip(edges[::2].tolist(), edges[1::2].tolist()))))
    return found


def result(docs, length, gram):
    return sorted(((r["id"], bytes(r["kept"]), r["n_bytes"], [tuple(s) for s in r["spans"]])
                   for r in without_repeats(docs, length=length, gram=gram).collect()), key=repr)


def texts(seed, n=60):
    chance = random.Random(seed)
    parts = ["".join(chance.choice("abé \n") for _ in range(chance.randrange(5, 90))) for _ in range(25)]
    made = []
    for _ in range(n):
        text = "".join(chance.choice(parts) if chance.random() < 0.6 else "".join(chance.choice("xyzü") for _ in range(20))
                       for _ in range(chance.randrange(0, 7)))
        made.append(text)
    return made + ["a" * 300, "a" * 200, "ab" * 100, None, "", made[3], made[5] + "!"]


@pytest.mark.parametrize("seed, length, gram", [(1, 20, 8), (2, 40, 16), (3, 100, 32), (4, 9, 9), (5, 33, 8)])
def test_bytes_that_go_are_those_of_a_dictionary_of_all_strings(spark, seed, length, gram):
    rows = list(enumerate(texts(seed)))
    random.Random(seed).shuffle(rows)
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, start int").repartition(5)
    assert result(docs, length, gram) == sorted(brute(rows, length), key=repr)


def test_small_steps_batches_and_joined_triggers(spark, monkeypatch):
    monkeypatch.setattr(module, "_AT_ONCE", 64)
    monkeypatch.setattr(module, "SENT_GRAMS", 0)
    monkeypatch.setattr(module, "MET_PHRASES", 3)
    monkeypatch.setattr(module, "_MANY", 2)
    rows = list(enumerate(texts(7)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert result(docs, 30, 12) == sorted(brute(rows, 30), key=repr)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_repeated_rows_null_ids_and_an_empty_table(spark):
    long = "".join(random.Random(8).choice("abcdefgh ") for _ in range(150))
    rows = [(1, long), (1, long), (1, "-" + long), (1, long + "tail"), (1, long + "tail"), (0, long[20:]), (None, "x" + long[:110]), (None, None), (2, long), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(docs, 100, 32) == sorted(brute(rows, 100), key=repr)
    assert without_repeats(docs.limit(0)).collect() == []


def test_text_ids(spark):
    rows = [("b", "q" * 150 + "w" * 30), ("a", "q" * 120)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    assert result(docs, 100, 32) == sorted(brute(rows, 100), key=repr)


def test_query_against_brute_force_on_whole_tables(spark, tables):
    rows = [tuple(r) for r in spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()]
    wanted = sorted((i, n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest()) for i, kept, n, spans in brute(rows, 100))
    found = CHECKS["op11_repeated_strings"].run(spark, tables)
    assert sorted(map(tuple, found.collect())) == wanted
    assert any(n for _, _, n, _, _ in wanted)
