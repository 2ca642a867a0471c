"""Decontamination, license scans, toxicity, quality and the pipeline on small tables."""

import random
import zlib

import numpy as np
import pytest

from tierlake.llm import decontaminate as D
from tierlake.llm import licenses as I
from tierlake.llm import quality as Q
from tierlake.llm import toxicity as X


def brute_leaks(docs, items, threshold):
    found = []
    for key, text in docs:
        words = D.words_of(text)
        for item, wanted in set(items):
            parts = D.words_of(wanted)
            if parts:
                width = min(5, len(parts))
                shared, size = len(D.shingles(parts, width) & D.shingles(words, width)), len(D.shingles(parts, width))
                if shared / size >= threshold - 1e-12:
                    found.append((key, item, size, shared))
    return sorted(found, key=repr)


@pytest.mark.parametrize("chars", [1 << 20, 200])
def test_leaks_equal_brute_force(spark, chars):
    pick = random.Random(1)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(pick.choice(words) for _ in range(pick.choice([1, 3, 5, 12, 30])))) for i in range(40)]
    items += [(40, None), (41, ""), (42, "!!"), items[3]]
    docs = [(None, None), (-1, ""), (-2, "w1")]
    for key in range(80):
        text = [pick.choice(words) for _ in range(200)]
        for _, item in pick.sample(items[:40], 3):
            part = item.upper().split()
            for _ in range(pick.choice([0, 0, 1, 3])):
                part[pick.randrange(len(part))] = "other"
            at = pick.randrange(200)
            text[at:at] = part
        docs.append((key, "; ".join(text)))
    docs.append(docs[-1])
    left = spark.createDataFrame([(k, t, 1) for k, t in docs], "doc_id long, text string, item int").repartition(3)
    right = spark.createDataFrame(items, "item_id long, text string")
    out = D.find_leaks(left, right, item_chars=chars).collect()
    wanted = brute_leaks(docs, items, 0.8)
    assert sorted([(r["id"], r["item"], r["item_shingles"], r["shared"]) for r in out], key=repr) == wanted
    clean = D.without_leaks(left, right, item_chars=chars)
    assert clean.columns == left.columns
    leaked = {k for k, *_ in wanted}
    assert sorted([r["doc_id"] for r in clean.collect()], key=repr) == sorted([k for k, _ in docs if k not in leaked], key=repr)
    assert D.find_leaks(left.limit(0), right).count() == 0 and D.find_leaks(left, right.limit(0)).count() == 0


def test_license_scan_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "MIT License mit license"), (4, "x\nLicensed under the Apache Licence, Version 2.0, as is"),
            (5, "gnu general public\nlicense"), (6, "the licensed under 0 2 version license is apache\nnothing"), (None, "cc-by " * 5000), (3, "MIT License mit license")]
    docs = spark.createDataFrame([(k, t, 0, "") for k, t in rows], "doc_id long, text string, n_words int, labels string")
    out = {r["id"]: r for r in I.scan_licenses(docs).collect()}
    assert (out[1]["n_words"], out[1]["n_base"], out[1]["first_word"], out[1]["labels"], out[1]["score"]) == (0, 0, None, "", 0.0)
    assert (out[3]["n_words"], out[3]["n_base"], out[3]["first_word"], out[3]["last_word"], out[3]["base_labels"]) == (4, 2, 0, 2, "mit")
    assert (out[4]["base_labels"], out[4]["labels"], out[4]["n_base"]) == ("", "apache-notice", 0) and out[4]["score"] == 0.875
    assert (out[5]["base_labels"], out[5]["first_word"]) == ("gpl", 0)
    assert out[6]["labels"] == "apache-notice" and out[6]["score"] == 1.0 or out[6]["score"] >= 0.8
    assert (out[None]["n_base"], out[None]["last_word"], out[None]["base_labels"]) == (5000, 9998, "cc-by")
    assert I.scan_licenses(docs).count() == len(rows) and I.scan_licenses(docs.limit(0)).count() == 0


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_set_similarity_join_is_exact(spark, threshold):
    pick = random.Random(2)
    words = [f"w{i}" for i in range(12)]
    templates = {f"t{k}": " ".join(pick.sample(words, pick.randint(1, 9))) for k in range(8)}
    known = sorted({w for t in templates.values() for w in t.split()})
    blocks = [(i, i % 3, pick.sample(known, pick.randint(0, len(known)))) for i in range(150)]
    got = I.matching_blocks(spark.createDataFrame(blocks, "row long, block int, words array<string>"), templates, threshold).collect()
    wanted = {(r, b, label, round(len(set(w) & set(t.split())) / len(set(t.split())), 9)) for r, b, w in blocks
              for label, t in templates.items() if len(set(w) & set(t.split())) >= threshold * len(set(t.split())) - 1e-9}
    assert {(r["row"], r["block"], r["label"], round(r["containment"], 9)) for r in got} == wanted and len(got) == len(wanted)


@pytest.fixture(scope="module")
def language(spark):
    return X.fit_language_model(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


@pytest.mark.parametrize("written", ["1diot", "i d i o t", "i.d.i.o.t", "i_d_i_o_t", "idiooot", "!d!ot", "iiidddiiioooottt", "I-D-I-O-T"])
def test_obfuscated_words_are_restored(language, written):
    assert "idiot" in X.Restorer(language).words(f"the {written} on")


def test_clean_words_stay(language):
    restorer = X.Restorer(language)
    assert restorer.words("Thandou onha, the 2.0 of") == {"thandou", "onha", "the", "of"}
    assert restorer.words("") == set() and restorer.words("a a a a a a") == {"a"}
    long = "x " * 20_000 + "1" * 9_000
    assert restorer.words(long)


def _auc(pairs):
    one, zero = ([s for s, l in pairs if l == k] for k in (1, 0))
    return np.mean([(a > b) + 0.5 * (a == b) for a in one for b in zero])


@pytest.mark.parametrize("query, label, size, least", [
    ("op7_toxicity", "toxic", "sf0.1", 0.95), ("op9_quality", "quality", "sf0.01", 0.98)])
def test_held_out_accuracy(spark, query, label, size, least):
    from tierlake.llm.queries import CHECKS
    folder = f"/root/testdata/{size}"
    rows = CHECKS[query].run(spark, folder).collect()
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)
    assert _auc([(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]) >= least


def test_models_on_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "word " * 50_000), (4, "an idiot text"), (4, "an idiot text"), (None, "x\ny")]
    docs = spark.createDataFrame([(k, t, 0.5, 1) for k, t in rows], "doc_id long, text string, score double, label int")
    labels = spark.createDataFrame([(4, 1), (1, 0), (1, None), (None, 1), (99, 0), (2, 0), (4, 1)], "doc_id long, mark int")
    for some in (labels, labels.filter("mark = 1"), labels.limit(0)):
        model = X.fit_toxicity(docs, some, label_column="mark")
        toxic = X.toxicity_scores(docs, model).collect()
        quality = Q.quality_scores(docs, some, label_column="mark").collect()
        for out in (toxic, quality):
            assert sorted([r["id"] for r in out], key=repr) == sorted([k for k, _ in rows], key=repr)
            assert all(0 <= r["score"] <= 1 for r in out)
        assert X.without_toxic(docs, model, threshold=2).columns == docs.columns
    assert Q.quality_scores(docs.limit(0), labels, label_column="mark").count() == 0
    assert X.toxicity_scores(docs.limit(0), X.fit_toxicity(docs.limit(0), labels, label_column="mark")).count() == 0


def test_discriminant_equals_normal_densities():
    pick = np.random.default_rng(0)
    roots = [pick.normal(size=(3, 3)) + 2 * np.eye(3) for _ in range(2)]
    covariances = [r @ r.T for r in roots]
    means, shares = pick.normal(size=(2, 3)), (0.3, 0.7)
    lower = [np.linalg.cholesky(c) for c in covariances]
    model = Q.Discriminant(means, np.array([np.linalg.inv(l) for l in lower]),
                           np.array([np.log(s) - np.log(np.diag(l)).sum() for s, l in zip(shares, lower)]))
    rows = pick.normal(size=(5, 3))
    density = [np.log(s) - 0.5 * np.log(np.linalg.det(c)) - 0.5 * np.einsum("ij,jk,ik->i", rows - m, np.linalg.inv(c), rows - m)
               for s, m, c in zip(shares, means, covariances)]
    assert np.allclose(model.log_odds(rows), density[1] - density[0])


def test_pipeline_stages(spark, tables):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    seen, columns = {r["doc_id"] for r in docs.collect()}, docs.columns
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, tables)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema).coalesce(1)
        kept = {r["doc_id"] for r in docs.collect()}
        assert kept <= seen and len(kept) > 0.7 * len(seen) and len(kept) == docs.count()
        seen = kept
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    assert not brute_leaks([(r["doc_id"], r["text"]) for r in docs.collect()], items, 0.8)
    packed = P.run(spark, tables).collect()
    assert {r["doc_id"] for r in packed} <= {r["doc_id"] for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}


def test_contradicting_batches_are_summed_alike(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert X.letter_counts(docs) == X.letter_counts(docs.repartition(7))
    table = Q._class_table()
    assert len(Q.statistics(b"", table)) == len(Q.FEATURES) == len(Q.statistics(b"A b\n|1", table))


@pytest.mark.parametrize("written, word", [
    ("!d10t", "idiot"), ("|d10t", "idiot"), ("1053r", "loser"), ("1d1070", "idioto"), ("iidiot", "idiot"), ("sscum", "scum"),
    ("mmoron", "moron"), ("(lown", "clown"), ("you are d u m b.", "dumb"), ("d u m b!", "dumb"), ("s c u m.", "scum"),
    ("what an a s s", "ass"), ("(d u m b)", "dumb")])
def test_disguises_are_read(spark, written, word):
    text = "you are what an idiot idioto loser scum moron clown dumb ass and that is all there was to say of him " * 20
    model = X.fit_language_model(spark.createDataFrame([(text,)], "text string"))
    assert word in X.Restorer(model).words(written)


@pytest.mark.parametrize("text, labels", [
    ("Released under the Apache License", "apache"), ("Licensed under CC BY 4.0", "cc-by,cc-by-notice"),
    ("Licensed under CC BY-NC 4.0", "cc-by,cc-by-nc-notice,cc-by-notice"), ("Licensed under the Acme License, Version 2.0", ""),
    ("Released under the MIT license.", "mit,mit-notice"),
    ("This work is licensed under the Acme free public license version 3", "")])
def test_a_notice_needs_its_distinguishing_words(spark, text, labels):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert [r["labels"] for r in I.scan_licenses(docs).collect()] == [labels]
