"""SimHash near-duplicates, found through a vantage-point tree over Hamming distance.

Fingerprints are 64 bits. A tree fitted on a bounded sample cuts the space into shards: each node
has a vantage fingerprint and a radius, and whatever lies within radius + reach goes inward,
whatever lies beyond the radius goes outward. By the triangle inequality two fingerprints at most
``reach`` apart always meet in one shard: only the ring between the two bounds is sent both ways.
Inside a shard the same cut is repeated down to small blocks, which are compared exactly.

A wide reach finds similarities well below one, but then the bounds of a tree over all texts prune
little and unrelated texts come near by chance. For that use each fingerprint carries some
min-hashes of its shingles, enough of which must agree for a link. Of ``mins`` with ``agreeing`` to
agree, at least one of the first ``mins - agreeing + 1`` does, so texts that share one of those make
a group, and trees are grown inside groups only. A large group is compared tile by tile.

Where a least Jaccard similarity of the shingle sets is asked for, fingerprints are those of the sets, each
shingle once, and the tree and the min-hashes only propose pairs: what lies within reach and agrees is then
decided by the sets themselves.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tierlake.llm.components import connected_components
from tierlake.session import materialize

SEED = 42
SAMPLE = 65_536       # fingerprints the tree is fitted on; every fingerprint is then routed through it
SHARD_ROWS = 30_000   # wanted distinct fingerprints in a shard, as far as the sample allows
LEAST_SAMPLED = 16    # sampled fingerprints a shard rests on
BLOCK = 1024          # fingerprints compared pair by pair
WORDS_AT_ONCE = 65_536
BANDS = 6             # min-hashes one of which texts must share to be compared by their shingles
COMPARED_ROWS = 4096  # texts in a tile, and about as many in a shard, whose shingles are compared
SET_REACH = 26        # bits in which fingerprints of sets with a Jaccard similarity of 0.8 may differ: some 10 do, with 3 about it
PRUNED = 256          # groups up to this size lose what has no partner before shingles are fetched
WIDEST = 0.7          # share of a group's texts in one side of a cut, at most: two such sides have fewer pairs than the whole
_PAIRS = 100_000      # linked pairs held before their trees are united
_MIXERS = np.random.Generator(np.random.PCG64(SEED)).integers(0, 2 ** 63, 64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _hashes(text: bytes, width: int) -> Iterator[np.ndarray]:
    """XXH64 of all shingles, repeats included, in pieces of bounded size."""
    words = text.lower().split()  # of bytes: only A-Z and the six ASCII spaces
    if not words:
        return
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    joined, ends = b" ".join(words), np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    span = min(width, len(words))
    shingles = len(words) - span + 1
    digest = xxhash.xxh64_intdigest
    for low in range(0, shingles, WORDS_AT_ONCE):
        high = min(low + WORDS_AT_ONCE, shingles)
        pairs = zip(starts[low:high].tolist(), ends[low + span - 1:high + span - 1].tolist())
        yield np.array([digest(joined[a:b], SEED) for a, b in pairs], np.uint64)


def shingle_set(pieces: Iterable[np.ndarray]) -> np.ndarray:
    """The distinct hashes, ascending."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *pieces]))


def _signature(pieces: Iterable[np.ndarray], mins: int) -> tuple[int, np.ndarray]:
    least = np.full(mins, np.iinfo(np.uint64).max, np.uint64)
    votes, shingles = np.zeros(64, np.int64), 0
    for hashes in pieces:
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
        shingles += len(hashes)
        for at in range(mins):
            least[at] = min(least[at], (hashes * _MIXERS[at]).min())
    return int(np.packbits(votes * 2 > shingles, bitorder="little").view(np.uint64)[0]), least


def simhash(text: bytes, width: int, mins: int = 0) -> tuple[int, np.ndarray]:
    """Majority vote of the bits of all shingles' hashes, repeats included, and ``mins`` min-hashes.

    No word gives zero and the largest values.
    """
    return _signature(_hashes(text, width), mins)


def fingerprints(docs: DataFrame, id_column: str, text_column: str, width: int, mins: int = 0, sets: bool = False) -> DataFrame:
    """(id, fingerprint, mins) of every row; 64 bits as a long, min-hashes as bytes. Null text is empty.

    With ``sets`` also (node, source): digests of the shingle set and of the text; the fingerprint is the set's then.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, least, nodes = [], [], []
            for text in batch.column(1).cast(pa.binary()):
                pieces = _hashes(text.as_py() or b"", width)
                if sets:
                    own = shingle_set(pieces)
                    nodes.append(xxhash.xxh3_128_digest(own.tobytes()))
                    pieces = [own[low:low + WORDS_AT_ONCE] for low in range(0, len(own), WORDS_AT_ONCE)]
                found, smallest = _signature(pieces, mins)
                prints.append(found)
                least.append(smallest.tobytes())
            columns = [batch.column(0), pa.array(np.array(prints, np.uint64).view(np.int64)), pa.array(least, pa.binary())]
            columns += [pa.array(nodes, pa.binary()), batch.column(2)] if sets else []
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["id", "fingerprint", "mins"] + ["node", "source"] * sets
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    if sets:
        rows = rows.withColumn("source", _source("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, fingerprint long, mins binary" + ", node binary, source binary" * sets)


def _source(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))))


def _best_cut(points: np.ndarray, reach: int) -> tuple[np.uint64, int, int]:
    """Vantage, radius, and the larger side of the cut, over a few vantages spread over the points."""
    best = (points[0], 0, len(points) + 1)
    for vantage in points[np.linspace(0, len(points) - 1, 8).astype(int)]:
        within = np.cumsum(np.bincount(np.bitwise_count(points ^ vantage), minlength=65))
        radius = np.arange(64 - reach)
        inner, outer = within[radius + reach], len(points) - within[radius]
        cost = np.maximum(inner, outer) + 0.5 * (inner + outer)
        at = int(np.argmin(cost))
        if max(inner[at], outer[at]) < best[2]:
            best = (vantage, at, int(max(inner[at], outer[at])))
    return best


def fit_tree(sample: np.ndarray, shards: int, reach: int) -> list[tuple[int, int, int, int]]:
    """Nodes (vantage, radius, inner, outer); a child below zero is shard -child - 1. [] is one shard."""
    nodes: list[tuple[int, int, int, int]] = []
    count = 0

    def grow(points: np.ndarray, wanted: float) -> int:
        nonlocal count
        if wanted > 1 and len(points) >= 2 * LEAST_SAMPLED:
            vantage, radius, larger = _best_cut(points, reach)
            if larger <= 0.9 * len(points):
                distance = np.bitwise_count(points ^ vantage)
                at = len(nodes)
                nodes.append((int(vantage), radius, 0, 0))
                inner = grow(points[distance <= radius + reach], wanted / 2)
                outer = grow(points[distance > radius], wanted / 2)
                nodes[at] = (int(vantage), radius, inner, outer)
                return at
        count += 1
        return -count

    grow(np.unique(sample), shards)
    return nodes


def route(nodes: list[tuple[int, int, int, int]], points: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, positions of the points that belong in it)."""
    waiting = [(0 if nodes else -1, np.arange(len(points)))]
    while waiting:
        at, own = waiting.pop()
        if at < 0:
            yield -at - 1, own
        elif len(own):
            vantage, radius, inner, outer = nodes[at]
            distance = np.bitwise_count(points[own] ^ np.uint64(vantage))
            waiting += [(inner, own[distance <= radius + reach]), (outer, own[distance > radius])]


def close_pairs(points: np.ndarray, reach: int, widest: float = 0.9) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (i, j) of all pairs at most ``reach`` bits apart, in pieces of bounded size.

    A pair may come more than once. Points that no vantage separates, with at most a share of ``widest`` on
    either side, are compared in blocks.
    """
    waiting = [np.arange(len(points))]
    while waiting:
        own = waiting.pop()
        if len(own) > BLOCK:
            vantage, radius, larger = _best_cut(points[own], reach)
            if larger <= widest * len(own):
                distance = np.bitwise_count(points[own] ^ vantage)
                waiting += [own[distance <= radius + reach], own[distance > radius]]
                continue
        for low in range(0, len(own), BLOCK):
            for right in range(low, len(own), BLOCK):
                a, b = own[low:low + BLOCK], own[right:right + BLOCK]
                i, j = np.nonzero(np.bitwise_count(points[a][:, None] ^ points[b][None, :]) <= reach)
                keep = a[i] < b[j]
                if keep.any():
                    yield a[i][keep], b[j][keep]


def _join_roots(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Unite the trees of i and j in place; ``root`` stays fully followed, the smallest leads."""
    while len(i):
        a, b = root[i], root[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        if len(i):
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(onward := root[root], root):
                root[:] = onward


def shard_links(points: np.ndarray, reach: int, mins: np.ndarray | None = None, agreeing: int = 0) -> np.ndarray:
    """For ascending points, the position of the smallest point each is linked to within the shard."""
    root = np.arange(len(points))
    held, size = [], 0
    for i, j in close_pairs(points, reach):
        if agreeing:
            apart = root[i] != root[j]
            i, j = i[apart], j[apart]
            alike = np.concatenate([np.zeros(0, bool)] + [
                (mins[i[low:low + _PAIRS]] == mins[j[low:low + _PAIRS]]).sum(axis=1) >= agreeing
                for low in range(0, len(i), _PAIRS)])
            i, j = i[alike], j[alike]
        held.append((i, j))
        size += len(i)
        if size > _PAIRS:
            _join_roots(root, *map(np.concatenate, zip(*held)))
            held, size = [], 0
    if held:
        _join_roots(root, *map(np.concatenate, zip(*held)))
    return root


def links(distinct: DataFrame, reach: int) -> DataFrame:
    """Edges (a, b) that connect just the ``distinct(fingerprint)`` rows linked within a shard."""
    rows = distinct.count()
    sample = [r[0] for r in distinct.select("fingerprint").orderBy(
        F.xxhash64("fingerprint"), "fingerprint").limit(SAMPLE).collect()]
    nodes = fit_tree(np.array(sample, np.int64).view(np.uint64), -(-rows // SHARD_ROWS), reach)

    def to_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(0).to_numpy(zero_copy_only=False)
            for shard, own in route(nodes, points.view(np.uint64), reach):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), shard)), pa.array(points[own])], ["shard", "fingerprint"])

    def link(table: pa.Table) -> pa.Table:
        points = np.sort(table.column("fingerprint").to_numpy())
        root = shard_links(points.view(np.uint64), reach)
        linked = np.nonzero(root != np.arange(len(points)))[0]
        return pa.table({"a": points[linked], "b": points[root[linked]]})

    routed = distinct.select("fingerprint").mapInArrow(to_shards, "shard long, fingerprint long")
    return routed.groupBy("shard").applyInArrow(link, "a long, b long")


def grouped_links(distinct: DataFrame, reach: int, mins: int, agreeing: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges (a, b) like ``links``, of the ``distinct(fingerprint, mins)`` rows linked within a group.

    Rows may share a fingerprint if they have a ``node`` each, which the edges name then. A group of more than ``shard_rows`` is cut into chunks by a hash, and each pair of chunks is a
    group of its own. Groups are dealt into shards of some ``shard_rows`` rows.
    """
    values = F.expr(f"transform(sequence(0, {mins - agreeing}), i -> struct(i AS at, substring(mins, 8 * i + 1, 8) AS value))")
    node = F.col("node" if "node" in distinct.columns else "fingerprint").alias("node")
    spread = distinct.select(node, "fingerprint", "mins", F.explode(values).alias("v")).select(
        "node", "fingerprint", "mins", "v.at", "v.value")
    sizes = spread.groupBy("at", "value").count().filter("count > 1")
    own = spread.join(sizes, ["at", "value"]).withColumn("chunks", F.ceil(F.col("count") / shard_rows))
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks"))
    pair = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    tiles = own.withColumn("chunk", chunk).withColumn("other", pair)
    key = F.xxhash64("at", "value", F.least("chunk", "other"), F.greatest("chunk", "other"))
    tiles = materialize(tiles.select(key.alias("key"), "node", "fingerprint", "mins"))
    shards = max(1, -(-tiles.count() // shard_rows))

    def link(table: pa.Table) -> pa.Table:
        keys, points = table.column("key").to_numpy(), table.column("fingerprint").to_numpy()
        order = np.lexsort((points, keys))
        keys, points = keys[order], points[order]
        held = table.column("mins").to_pylist()
        hashes = np.frombuffer(b"".join(held), np.uint64).reshape(len(held), -1)[order]
        nodes = table.column("node").take(pa.array(order))
        a, b = [], []
        for group in np.split(np.arange(len(keys)), np.nonzero(np.diff(keys))[0] + 1):
            root = shard_links(points[group].view(np.uint64), reach, hashes[group], agreeing)
            linked = np.nonzero(root != np.arange(len(group)))[0]
            a.append(group[linked])
            b.append(group[root[linked]])
        return pa.table({"a": nodes.take(pa.array(np.concatenate(a))), "b": nodes.take(pa.array(np.concatenate(b)))})

    kind = tiles.schema["node"].dataType.simpleString()
    return tiles.withColumn("shard", F.pmod("key", F.lit(shards))).groupBy("shard").applyInArrow(link, f"a {kind}, b {kind}")


def _candidates(
    points: np.ndarray, mins: np.ndarray, band: int, agreeing: int, reach: int, root: np.ndarray | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of a group's texts that the tree finds within ``reach``, that agree enough and share no band before ``band``.

    Pairs that ``root``, which the caller may go on changing, has linked by then are left out.
    """
    for i, j in close_pairs(points, reach, WIDEST):
        for low in range(0, len(i), _PAIRS):
            a, b = i[low:low + _PAIRS], j[low:low + _PAIRS]
            if root is not None:
                apart = root[a] != root[b]
                a, b = a[apart], b[apart]
            same = mins[a] == mins[b]
            near = (same.sum(axis=1) >= agreeing) & ~same[:, :band].any(axis=1)
            yield a[near], b[near]


def with_partner(points: np.ndarray, mins: np.ndarray, band: int, agreeing: int, reach: int) -> np.ndarray:
    """Which texts of a group that shares min-hash ``band`` have a candidate in it."""
    found = np.zeros(len(mins), bool)
    for i, j in _candidates(points, mins, band, agreeing, reach):
        found[i] = found[j] = True
    return found


def similar(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Whether two sets, ascending, have a Jaccard similarity of ``least`` or more."""
    if min(len(a), len(b)) < least * max(len(a), len(b)) - 1e-9:
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return shared >= least * (len(both) - shared) - 1e-9


def similar_links(
    points: np.ndarray, mins: np.ndarray, sets: list[np.ndarray], band: int, agreeing: int, least: float, reach: int,
) -> np.ndarray:
    """For the texts of a group, the position of the first text each is linked to.

    Candidates are compared by their sets, unless they are linked already.
    """
    root = np.arange(len(sets))
    for i, j in _candidates(points, mins, band, agreeing, reach, root):
        for one, two in zip(i.tolist(), j.tolist()):
            if root[one] != root[two] and similar(sets[one], sets[two], least):
                _join_roots(root, np.array([one]), np.array([two]))
    return root


def verified_links(
    distinct: DataFrame, texts: DataFrame, width: int, mins: int, agreeing: int, least: float, tile_rows: int = COMPARED_ROWS,
    reach: int = SET_REACH,
) -> DataFrame:
    """Edges (a, b) that connect just the ``distinct(node, fingerprint, mins, source)`` rows with a Jaccard of ``least``.

    Rows that share one of the first ``BANDS`` min-hashes are a group, in which the tree finds the pairs with
    fingerprints at most ``reach`` bits apart. Those that agree in ``agreeing`` of ``mins`` are compared,
    each in the first band it shares. ``texts(source, text)`` gives the
    shingles, of what has a candidate. Groups are cut and dealt as in ``grouped_links``.
    """
    values = F.expr(f"transform(sequence(0, {min(BANDS, mins) - 1}), i -> struct(i AS at, substring(mins, 8 * i + 1, 8) AS value))")
    spread = distinct.select("node", "source", "fingerprint", "mins", F.explode(values).alias("v")).select(
        "node", "source", "fingerprint", "mins", "v.at", "v.value")
    sizes = spread.groupBy("at", "value").count().filter("count > 1")
    own = spread.join(sizes, ["at", "value"]).withColumn("chunks", F.ceil(F.col("count") / tile_rows))
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks"))
    tiles = own.withColumn("chunk", chunk).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    key = F.xxhash64("at", "value", F.least("chunk", "other"), F.greatest("chunk", "other"))
    tiles = materialize(tiles.select(key.alias("key"), "at", "node", "source", "fingerprint", "mins"))
    shards = max(1, -(-tiles.count() // tile_rows))

    def groups(table: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(band, positions, fingerprints, min-hashes) of each group."""
        points = table.column("fingerprint").to_numpy().view(np.uint64)
        keys, bands = table.column("key").to_numpy(), table.column("at").to_numpy()
        hashes = np.frombuffer(b"".join(table.column("mins").to_pylist()), np.uint64).reshape(len(keys), -1)
        order = np.lexsort((bands, keys))
        cuts = np.nonzero((np.diff(keys[order]) != 0) | (np.diff(bands[order]) != 0))[0] + 1
        for group in np.split(order, cuts):
            yield int(bands[group[0]]), group, points[group], hashes[group]

    def prune(table: pa.Table) -> pa.Table:
        kept = [group if len(group) > PRUNED else group[with_partner(points, own, band, agreeing, reach)]
                for band, group, points, own in groups(table)]
        return table.select(["key", "at", "node", "source", "fingerprint", "mins", "shard"]).take(pa.array(np.concatenate(kept)))

    def link(table: pa.Table) -> pa.Table:
        held = table.column("shingles").to_pylist()
        a, b = [], []
        for band, group, points, own in groups(table):
            sets = [np.frombuffer(held[k], np.uint64) for k in group]
            root = similar_links(points, own, sets, band, agreeing, least, reach)
            linked = np.nonzero(root != np.arange(len(group)))[0]
            a.append(group[linked])
            b.append(group[root[linked]])
        nodes = table.column("node")
        return pa.table({"a": nodes.take(pa.array(np.concatenate(a))), "b": nodes.take(pa.array(np.concatenate(b)))})

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(_hashes(t.as_py(), width)).tobytes() for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["source", "shingles"])

    dealt = tiles.withColumn("shard", F.pmod("key", F.lit(shards)))
    left = materialize(dealt.groupBy("shard").applyInArrow(
        prune, "key long, at int, node binary, source binary, fingerprint long, mins binary, shard long"))
    needed = left.select("source").distinct()
    rows = texts.join(needed, "source", "left_semi").dropDuplicates(["source"]).select("source", "text")
    sets = rows.mapInArrow(shingles, "source binary, shingles binary")
    return left.join(sets, "source").groupBy("shard").applyInArrow(link, "a binary, b binary")


def near_duplicate_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 3, reach: int = 2,
    mins: int = 0, agreeing: int = 0, least: float | None = None,
) -> DataFrame:
    """(id, fingerprint, component) of every row: fingerprints at most ``reach`` bits apart link.

    ``width`` words make a shingle. With ``mins`` min-hashes at least ``agreeing`` of them must agree
    too, also where fingerprints are equal. With ``least`` as well, fingerprints are of the sets of shingles, and
    of the texts within reach that agree those link whose sets (by 64-bit hashes) have a Jaccard similarity of
    ``least`` or more; ``docs`` must give the same texts when it is read again then. The component is the smallest id that can be reached, the own included; null ids count
    only where a component has no other, and it is null then. Null and blank texts have fingerprint
    zero and link like any other. Repeated rows give repeated rows, an empty table an empty one.
    Other columns are not looked at.
    """
    prints = materialize(fingerprints(docs, id_column, text_column, width, mins, least is not None))
    if least is not None:
        pass  # the node is the set's digest
    elif mins:  # equal fingerprints alone do not make a class
        prints = prints.withColumn("node", F.unhex(F.md5(F.concat(F.hex("fingerprint"), F.hex("mins")))))
    else:
        prints = prints.withColumn("node", F.col("fingerprint"))
    source = [F.min("source").alias("source")] if least is not None else []
    classes = materialize(prints.groupBy("node").agg(
        F.min("fingerprint").alias("fingerprint"), F.min("id").alias("first"), F.min("mins").alias("mins"), *source))
    if least is not None:
        texts = docs.select(_source(text_column).alias("source"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
        edges = verified_links(classes, texts, width, mins, agreeing, least, reach=reach)
    else:
        edges = grouped_links(classes, reach, mins, agreeing) if mins else links(classes, reach)
    roots = materialize(connected_components(edges))
    grouped = classes.join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    smallest = grouped.groupBy("root").agg(F.min("first").alias("component"))
    labelled = grouped.join(smallest, "root").select("node", "component")
    return prints.join(labelled, "node").select("id", "fingerprint", "component")


#: At a similarity of exactly 0.8 a pair shares none of six min-hashes in 0.2 ** 6 = 0.00006 of all
#: cases and fewer than six of sixteen in some 0.00003; above it, more rarely. Its fingerprints are more than
#: ``SET_REACH`` bits apart in some 0.000001 (sets of five shingles and fewer: 0.00002).
SIMILAR = {"width": 5, "reach": SET_REACH, "mins": 16, "agreeing": 6, "least": 0.8}


def one_of_each_group(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the smallest id stays, once.

    Groups are by ``SIMILAR``: SimHash fingerprints within reach, then a Jaccard similarity of 0.8 of five-word shingles, link. ``docs`` must give the same rows in the same order when it is read
    again, as files do. Null ids stay only where a group has no other. All columns are kept.
    """
    row = F.monotonically_increasing_id()
    key = F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"), row.alias("row"))
    numbered = docs.select(key.alias("key"), F.col(text_column).alias("text"))
    groups = near_duplicate_groups(numbered, "key", "text", **SIMILAR)
    kept = materialize(groups.filter(F.col("id") == F.col("component")).select(F.col("id.row").alias("kept")))
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), row.alias("row"))
    return whole.join(kept, F.col("row") == F.col("kept"), "left_semi").select("doc.*")
