"""Token pieces against the tokenizer itself, packing against its contract and lower bounds."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tierlake.llm import packing as P

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)
ODD = ["", " ", "a  b", "  x", "a\n\nb", "a <|endoftext|> b", "é  ", "x \n y", "don't 's I'LL", "a\tb c", "　x", "a  b",
       "日本 語 テキスト", "a\u0085 b", "\x1c b", "tail ", "1 22 333!!! ...", "a​ b", "ﬁ ﬀ", "🙂 🙂🙂"]


def exact(text):
    return TOKENIZER.encode(text, add_special_tokens=False).ids


def test_ids_are_the_tokenizers(spark, tables):
    texts = [r[0] for r in spark.read.parquet(f"{tables}/documents.parquet").select("text").collect()] + ODD
    assert [list(ids) for ids in P.encode_batch(pa.array(texts, pa.string()), PATH)] == [exact(t) for t in texts]
    sliced = pa.array(["skipped", *ODD], pa.string()).slice(1)
    assert [list(ids) for ids in P.encode_batch(sliced, PATH)] == [exact(t) for t in ODD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab é\n\t.,'1  🙂<|>"), max_size=25), max_size=4))
def test_ids_of_random_texts(texts):
    assert [list(ids) for ids in P.encode_batch(pa.array(texts, pa.string()), PATH)] == [exact(t) for t in texts]


@pytest.mark.parametrize("length, pieces", [
    (1, [(0, 1)]), (1024, [(0, 1024)]), (1025, [(0, 1), (1, 1024)]), (2048, [(0, 1024), (1024, 1024)]),
    (2500, [(0, 452), (452, 1024), (1476, 1024)])])
def test_only_the_first_piece_may_be_short(length, pieces):
    assert P.cut(length, 1024) == pieces


def check_contract(rows, texts, capacity=1024):
    by_document, by_sequence = {}, {}
    for r in rows:
        by_document.setdefault(r["id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for key, text in texts.items():
        ids = np.array([*exact(text or ""), 2], "<u4")
        pieces = sorted(by_document.pop(key), key=lambda r: r["piece"])
        assert [(r["start"], r["length"]) for r in pieces] == P.cut(len(ids), capacity)
        assert [r["ids_crc32"] for r in pieces] == [zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes()) for r in pieces]
    assert not by_document
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by_sequence)


def test_documents_are_packed_tightly(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    rows = P.pack_documents(docs, PATH).collect()
    sequences = check_contract(rows, {r["doc_id"]: r["text"] for r in docs.collect()})
    bound = P.lower_bound(np.array([r["length"] for r in rows]), 1024)
    assert bound <= sequences <= bound * 1.02 + 1


def test_odd_rows(spark):
    texts = {1: None, 2: "", 3: "word " * 3000, None: "x", 5: "a <|endoftext|>"}
    docs = spark.createDataFrame([(k, t, 7, "z") for k, t in texts.items()], "doc_id long, text string, offset int, sequence_id string")
    check_contract(P.pack_documents(docs, PATH).collect(), texts)
    twice = P.pack_documents(docs.unionAll(docs), PATH).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in twice}) == len(twice) == 2 * len(P.pack_documents(docs, PATH).collect())
    assert P.pack_documents(docs.filter("doc_id > 9"), PATH).count() == 0
    kept = P.pack_documents(docs.filter("doc_id = 5"), PATH, keep_ids=True).first()
    assert kept["ids"] == [*exact("a <|endoftext|>"), 2]


def test_exchange_of_open_sequences_saves_some(spark):
    pick = np.random.default_rng(3)
    lengths = [int(n) for n in pick.integers(300, 700, 2000)]
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "id long, length long").repartition(3)

    def sequences(rounds):
        rows = P.pack_sequences(pieces, group_rows=100, rounds=rounds).collect()
        assert sorted(r["id"] for r in rows) == list(range(2000))
        totals = {}
        for r in rows:
            totals[r["sequence_id"]] = totals.get(r["sequence_id"], 0) + r["length"]
        assert max(totals.values()) <= 1024
        return len(totals)

    assert P.lower_bound(np.array(lengths), 1024) <= sequences(4) < sequences(0)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 10), min_size=1, max_size=7))
def test_lower_bound_never_exceeds_the_best_packing(lengths):
    def best(rest, bins):
        if not rest:
            return len(bins)
        options = [bins[:i] + [b + rest[0]] + bins[i + 1:] for i, b in enumerate(bins) if b + rest[0] <= 10] + [bins + [rest[0]]]
        return min(best(rest[1:], o) for o in options)

    found = np.array(lengths)
    optimum = best(sorted(lengths, reverse=True), [])
    assert P.lower_bound(found, 10) <= optimum <= P.best_fit(found, 10)[2]
