"""SimHash groups against brute force, and the vantage-point tree against all pairs."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.llm import simhash as S
from tierlake.llm.components import connected_components


def brute_print(text, width):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    parts = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << bit for bit in range(64) if sum(h >> bit & 1 for h in hashes) * 2 > len(hashes))


def brute_groups(rows, width, reach):
    prints = [brute_print(text, width) for _, text in rows]
    group = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (prints[i] ^ prints[j]).bit_count() <= reach and group[j] > group[i]:
                    group[j], changed = group[i], True
    smallest = {}
    for (key, _), g in zip(rows, group):
        smallest[g] = min((k for k in (smallest.get(g), key) if k is not None), default=None)
    return sorted(((key, f"{p:016x}", smallest[g]) for (key, _), p, g in zip(rows, prints, group)), key=repr)


def found(df):
    rows = df.select("id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")), "component").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_groups_equal_brute_force(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found(S.near_duplicate_groups(docs)) == brute_groups(rows, 3, 2)


def test_odd_rows(spark):
    rows = [(5, "A b  C"), (3, "a B c"), (3, "a B c"), (None, None), (None, ""), (7, " \t "), (8, "one"), (9, "ONE"),
            (None, "alone here now"), (10, "é x y " * 4000)]
    docs = spark.createDataFrame([(a, b, 1, "x") for a, b in rows], "doc_id long, text string, fingerprint int, component string")
    assert found(S.near_duplicate_groups(docs)) == brute_groups(rows, 3, 2)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicate_groups(docs).count() == 0 and S.one_of_each_group(docs).count() == 0


@pytest.mark.parametrize("reach", [1, 2, 6])
def test_tree_meets_every_close_pair(reach):
    pick = np.random.default_rng(reach)
    centres = pick.integers(0, 2 ** 63, 600).astype(np.uint64)
    flips = np.uint64(1) << pick.integers(0, 63, (600, 5)).astype(np.uint64)
    points = np.unique(np.concatenate([centres, *(np.bitwise_xor.reduce(flips[:, :k], axis=1) ^ centres for k in (1, 2, 3, 5))]))
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= reach
    wanted = {(i, j) for i, j in zip(*np.nonzero(near)) if i < j}
    nodes = S.fit_tree(points[::3], 16, reach)
    met = set()
    for _, own in S.route(nodes, points, reach):
        members = set(own.tolist())
        met |= {(i, j) for i, j in wanted if i in members and j in members}
    assert (nodes or reach > 2) and met == wanted
    before, S.BLOCK = S.BLOCK, 64
    try:
        pairs = {(int(a), int(b)) for i, j in S.close_pairs(points, reach) for a, b in zip(i, j)}
    finally:
        S.BLOCK = before
    assert pairs == wanted


def test_points_that_no_vantage_separates():
    points = np.arange(3000, dtype=np.uint64)  # all within twelve bits
    root = S.shard_links(points, 12)
    assert not root.any()


def test_components(spark):
    pairs = [(i, i + 1) for i in range(20, 60)] + [(3, 9), (9, 4), (4, 3), (7, 7), (100, 1), (2, 100), (None, 5)]
    roots = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert roots == {i: 20 for i in range(20, 61)} | {3: 3, 4: 3, 9: 3, 1: 1, 2: 1, 100: 1}


def test_one_of_each_group_keeps_columns_and_clean_rows(spark):
    words = [f"w{i}" for i in range(300)]
    near = words[:150] + ["other"] + words[151:]
    rows = [(2, " ".join(words), 1), (1, " ".join(near), 2), (1, " ".join(near), 3), (4, " ".join(reversed(words)), 4),
            (None, " ".join(words), 5), (None, "quite another text of its own", 6), (5, None, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int").coalesce(1)
    kept = S.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r["row"] for r in kept.collect()) == [2, 4, 6, 7]
    assert kept.schema["row"].dataType == T.IntegerType()


@pytest.mark.parametrize("shard_rows", [30_000, 40])
def test_grouped_links_equal_brute_force(spark, shard_rows):
    pick = np.random.default_rng(5)
    base = pick.integers(0, 2 ** 63, 40).astype(np.uint64)
    rows = {}
    for at in range(400):
        own = int(pick.integers(0, 40)) if at % 3 else 0  # a third of all in one group
        point = int(base[own]) ^ (1 << int(pick.integers(0, 63))) ^ (1 << int(pick.integers(0, 63)))
        mins = np.full(6, own, np.uint64)
        mins[pick.integers(0, 6, int(pick.integers(0, 5)))] = 1000 + at
        rows[point] = mins
    points = sorted(rows)
    wanted = {(a, b) for a in points for b in points if b < a and (a ^ b).bit_count() <= 4 and (rows[a] == rows[b]).sum() >= 4}
    table = spark.createDataFrame([(p, bytearray(rows[p].tobytes())) for p in points], "fingerprint long, mins binary")
    edges = S.grouped_links(table, 4, 6, 4, shard_rows)
    roots = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    brute = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(sorted(wanted), "a long, b long")).collect()}
    assert roots == brute and len(roots) > 100


def jaccard(a, b):
    shingles = [{tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)} for t in (a, b)]
    return len(shingles[0] & shingles[1]) / len(shingles[0] | shingles[1])


def test_wide_reach_finds_most_similar_texts(spark):
    pick = np.random.default_rng(1)
    rows, pairs = [], []
    for at in range(150):
        words = [f"{at}x{i}" for i in range(pick.integers(80, 400))]
        copy = list(words)
        for place in pick.integers(0, len(words), max(1, len(words) // 90)):
            copy[place] = "changed"
        rows += [(2 * at, " ".join(words)), (2 * at + 1, " ".join(copy))]
        if jaccard(rows[-2][1], rows[-1][1]) >= 0.8:
            pairs.append(2 * at + 1)
    kept = {r[0] for r in S.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)).select("doc_id").collect()}
    assert all(2 * at in kept for at in range(150))
    assert len(pairs) > 80 and sum(p not in kept for p in pairs) >= 0.9 * len(pairs)


def test_equal_fingerprints_alone_do_not_link(spark):
    def leaders(name):
        return " ".join(["."] * 400 + [f"{name}{i}" for i in range(300)])

    rows = [(1, leaders("a")), (2, leaders("b")), (3, leaders("a") + " end"), (4, leaders("b") + " end")]
    prints = [S.simhash(text.encode(), 5, 16) for _, text in rows]
    assert len({p for p, _ in prints}) == 1 and (prints[0][1] == prints[1][1]).sum() < 11
    kept = S.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2]


def test_links_are_decided_by_the_shingles_themselves(spark):
    pick = np.random.default_rng(3)
    rows, similar, apart = [], [], []
    for at in range(600):
        words = [f"{at}x{i}" for i in range(pick.integers(150, 400))]
        copy = list(words)
        for place in pick.integers(0, len(words), int(len(words) * pick.uniform(0.015, 0.05))):
            copy[place] = f"changed{place}"
        rows += [(2 * at, " ".join(words)), (2 * at + 1, " ".join(copy))]
        alike = jaccard(rows[-2][1], rows[-1][1])
        similar += [2 * at + 1] if 0.8 <= alike <= 0.85 else []
        apart += [2 * at + 1] if 0.6 <= alike < 0.8 else []
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    kept = {r[0] for r in S.one_of_each_group(docs).select("doc_id").collect()}
    assert len(similar) > 60 and len(apart) > 150
    assert not kept & set(similar) and set(apart) <= kept


@pytest.mark.parametrize("tile_rows, pruned", [(4096, 256), (7, 0)])
def test_verified_links_equal_brute_force(spark, monkeypatch, tile_rows, pruned):
    monkeypatch.setattr(S, "PRUNED", pruned)
    pick = np.random.default_rng(8)
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(base)] + [" ".join(w if pick.random() > 0.02 else f"z{at}" for w in base) for at in range(60)]
    texts.append(" ".join(["w1"] * 300 + base))  # repeats do not count
    rows = [(at, text) for at, text in enumerate(texts)]
    prints = S.fingerprints(spark.createDataFrame(rows, "id long, text string"), "id", "text", 5, 16, True)
    pieces = spark.createDataFrame(rows, "id long, text string").select(S._source("text").alias("source"), "text")
    edges = S.verified_links(prints, pieces, 5, 16, 6, 0.8, tile_rows)
    names = {bytes(r["node"]): r["id"] for r in prints.select("node", "id").collect()}
    group = {at: at for at in range(len(texts))}
    for one, two in [(names[bytes(r["a"])], names[bytes(r["b"])]) for r in edges.collect()]:
        assert jaccard(texts[one], texts[two]) > 0.5
        group = {k: min(group[one], group[two]) if g in (group[one], group[two]) else g for k, g in group.items()}
    wanted = {at: at for at in range(len(texts))}
    for i in range(len(texts)):
        for j in range(i):
            if jaccard(texts[i], texts[j]) >= 0.8:
                low, high = sorted((wanted[i], wanted[j]))
                wanted = {k: low if g == high else g for k, g in wanted.items()}
    by = {bytes(r["node"]): None for r in prints.select("node").collect()}
    assert len(by) > 50 and len(set(wanted.values())) > 1
    assert all((group[names[a]] == group[names[b]]) == (wanted[names[a]] == wanted[names[b]]) for a in by for b in by)


@pytest.mark.parametrize("tile_rows, pruned, block", [(4096, 256, 1024), (9, 0, 8)])
@pytest.mark.parametrize("reach", [-1, 3, 6])
def test_verified_links_need_fingerprints_within_reach(spark, monkeypatch, tile_rows, pruned, block, reach):
    monkeypatch.setattr(S, "PRUNED", pruned)
    monkeypatch.setattr(S, "BLOCK", block)
    pick = np.random.default_rng(12)
    base = [f"w{i}" for i in range(150)]
    rows = [(at, " ".join(w if pick.random() > 0.01 else f"z{at}" for w in base)) for at in range(40)]
    docs = spark.createDataFrame(rows, "id long, text string")
    prints = S.fingerprints(docs, "id", "text", 5, 16, True)
    held = {r["id"]: r for r in prints.collect()}
    edges = S.verified_links(prints, docs.select(S._source("text").alias("source"), "text"), 5, 16, 6, 0.8, tile_rows, reach)
    roots = {bytes(r["node"]): bytes(r["root"]) for r in connected_components(edges).collect()}

    def apart(i, j):
        return ((held[i]["fingerprint"] ^ held[j]["fingerprint"]) & (2 ** 64 - 1)).bit_count()

    wanted = [(held[i]["node"], held[j]["node"]) for i, a in rows for j, b in rows
              if i < j and apart(i, j) <= reach and jaccard(a, b) >= 0.8]
    brute = connected_components(spark.createDataFrame(wanted, "a binary, b binary"))
    assert roots == {bytes(r["node"]): bytes(r["root"]) for r in brute.collect()}
    assert len(roots) < 40 and (reach < 0 or roots)


def test_fingerprints_of_sets_do_not_count_repeats(spark):
    words = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame([(1, words), (2, f"{words} {words}"), (3, None), (4, " ")], "id long, text string")
    one, two, none, blank = (r["fingerprint"] for r in S.fingerprints(docs, "id", "text", 5, 16, True).orderBy("id").collect())
    assert ((one ^ two) & (2 ** 64 - 1)).bit_count() <= 12 and none == blank == 0


@pytest.mark.parametrize("least, most", [(4, 5), (8, 10), (40, 50), (90, 90)])
def test_reach_holds_sets_of_similarity_point_eight(least, most):
    pick, shared = np.random.default_rng(least), least if least < most else 80
    missed = 0
    for _ in range(3000):
        hashes = pick.integers(0, 2 ** 64, least + most - shared, dtype=np.uint64)
        a, b = (S._signature([own], 0)[0] for own in (hashes[:least], np.concatenate([hashes[:shared], hashes[least:]])))
        missed += (a ^ b).bit_count() > S.SET_REACH
    assert missed <= 1
