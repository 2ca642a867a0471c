"""Alignment of two tokenizers over the same text, in Arrow arrays.

Texts are encoded by both tokenizers once and written as packed ids. From there all work is on flat
Arrow arrays: lists are flattened with their parent indices, token lengths are summed up within each
document to byte ends, and an Acero hash join on (document, end) finds where both tokenizers end a
token. Those common ends cut the tokens into groups. Between two neighbouring ends of either
tokenizer lies exactly one overlapping pair, so the merged ends are the links. How many documents
hold a pair of ids linked is counted by ``Table.group_by`` within tasks and summed by Spark.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tierlake.llm.packing import _byte_of
from tierlake.session import materialize, shared_folder

SLICE_BYTES = 2 << 20     # text or packed ids that are worked on at once, but for a single longer document
PARTIAL_ROWS = 1 << 20    # distinct pairs a task holds before it passes its counts on
BROADCAST_BYTES = 96 << 20  # pair counts up to this size are sent to every executor, 12 bytes a pair
_SEPARATORS = (",", "|", ";", "")


@dataclass(frozen=True)
class Vocabulary:
    """The bytes of every token of both tokenizers."""

    a: pa.LargeBinaryArray
    b: pa.LargeBinaryArray

    def lengths(self, side: str) -> np.ndarray:
        return pc.binary_length(getattr(self, side)).to_numpy(zero_copy_only=False).astype(np.int64)


@lru_cache(maxsize=1)
def _tokenizers(a_path: str, b_path: str):
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True  # their strings in a text are ordinary text
    return a, sentencepiece.SentencePieceProcessor(model_file=b_path)


@lru_cache(maxsize=1)
def vocabulary(a_path: str, b_path: str) -> Vocabulary:
    """A's entries decoded from the byte-level alphabet; B's pieces with U+2581 as space and <0xHH> as a byte."""
    a, b = _tokenizers(a_path, b_path)
    byte_of, entries = _byte_of(), {k: t for t, k in a.get_vocab(with_added_tokens=True).items()}
    a_bytes = [bytes(byte_of[c] for c in entries[k]) if k in entries and all(c in byte_of for c in entries[k]) else
               entries.get(k, "").encode() for k in range(max(entries) + 1)]
    pieces = [b.id_to_piece(k) for k in range(b.get_piece_size())]
    b_bytes = [bytes([int(p[3:-1], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
    return Vocabulary(pa.array(a_bytes, pa.large_binary()), pa.array(b_bytes, pa.large_binary()))


@lru_cache(maxsize=1)
def _faster(a_path: str):
    """The same byte-level vocabulary for ``tiktoken``."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer
    a, byte_of = Tokenizer.from_file(a_path), _byte_of()
    added = {t.content for t in a.get_added_tokens_decoder().values()}
    ranks = {bytes(map(byte_of.__getitem__, t)): k for t, k in a.get_vocab(with_added_tokens=False).items() if t not in added}
    return tiktoken.Encoding(a_path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """(offset, count) of consecutive rows that hold at most ``SLICE_BYTES``, or a single row."""
    low, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > low and total + size > SLICE_BYTES:
            yield low, i - low
            low, total = i, 0
        total += size
    if low < len(sizes):
        yield low, len(sizes) - low


def _packed(lists: list[np.ndarray], kept: np.ndarray) -> pa.Array:
    """Lists of ids as little-endian 16 bit numbers, or 32 bit ones and one more byte; empty where not ``kept``."""
    found = []
    for ids, wanted in zip(lists, kept.tolist()):
        if not wanted or not len(ids):
            found.append(b"")
        else:
            found.append(ids.astype("<u2").tobytes() if ids.max() < 1 << 16 else ids.astype("<u4").tobytes() + b"\0")
    return pa.array(found, pa.binary())


def _unpacked(column: pa.Array) -> pa.LargeListArray:
    """The lists of ids again."""
    parts, ends = [], [0]
    for packed in column:
        packed = packed.as_py()
        ids = np.frombuffer(packed, "<u2") if len(packed) % 2 == 0 else np.frombuffer(packed[:-1], "<u4")
        parts.append(ids.astype(np.int32))
        ends.append(ends[-1] + len(ids))
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
    return pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(flat))


def _spells(lists: list[np.ndarray], entries: pa.LargeBinaryArray, wanted: list[bytes]) -> np.ndarray:
    """Whether each list's tokens spell the wanted bytes."""
    spelt = pc.take(entries, pa.array(np.concatenate([*lists, np.zeros(0, np.uint32)])))
    offsets = np.frombuffer(spelt.buffers()[1], np.int64, len(spelt) + 1) if len(spelt) else np.zeros(1, np.int64)
    ends = offsets[np.cumsum([len(ids) for ids in lists], dtype=np.int64)]
    view, low, found = memoryview(spelt.buffers()[2] or b"").cast("B"), 0, []
    for end, text in zip(ends.tolist(), wanted):
        found.append(view[low:end] == text)
        low = end
    return np.array(found, bool)


def encode(docs: DataFrame, a_path: str, b_path: str, id_column: str, text_column: str) -> DataFrame:
    """(id, a, b): packed ids of every row of ``docs``, both empty where one tokenizer does not spell the text.

    A encodes a space and the text, B the text; both must spell the former.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, entries = _tokenizers(a_path, b_path)[1], vocabulary(a_path, b_path)
        ordinary = _faster(a_path).encode_ordinary
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            for low, count in _slices(pc.binary_length(texts).to_numpy(zero_copy_only=False)):
                own = texts.slice(low, count).to_pylist()
                wanted = [(" " + t).encode() if t else b"" for t in own]
                a = [np.array(ordinary(" " + t) if t else [], np.uint32) for t in own]
                b = [np.array(ids, np.uint32) for ids in pieces.encode(own, out_type=int, num_threads=1)]
                kept = _spells(a, entries.a, wanted) & _spells(b, entries.b, wanted)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, count), _packed(a, kept), _packed(b, kept)], ["id", "a", "b"])

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, a binary, b binary")


@dataclass
class Aligned:
    """Links and groups of some documents, in document and text order; ``doc`` columns count from 0."""

    n_docs: int
    a: np.ndarray          # ids of A's tokens
    b: np.ndarray
    a_doc: np.ndarray
    b_doc: np.ndarray
    a_common: np.ndarray   # whether a token of the other side ends at the token's end
    b_common: np.ndarray
    link_a: np.ndarray     # token numbers of each overlapping pair
    link_b: np.ndarray

    def pairs(self, width: int) -> np.ndarray:
        """Each link's ids as one number."""
        return self.a[self.link_a] * np.int64(width) + self.b[self.link_b]

    def link_docs(self) -> np.ndarray:
        return self.a_doc[self.link_a]

    def per_document(self, docs: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        if weights is None:
            return np.bincount(docs, minlength=self.n_docs)
        total = np.zeros(self.n_docs, np.int64)
        if len(docs):
            first = np.flatnonzero(np.append(True, docs[1:] != docs[:-1]))
            total[docs[first]] = np.add.reduceat(weights, first)
        return total

    def group_digests(self, table: pa.LargeStringArray, width: int) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2,b3``: both sides' ids of each group; '' without tokens."""
        a_ends, b_ends = np.flatnonzero(self.a_common), np.flatnonzero(self.b_common)
        a_group = np.cumsum(self.a_common) - self.a_common
        b_group = np.cumsum(self.b_common) - self.b_common
        a_place = np.arange(len(self.a)) + np.append(0, b_ends + 1)[a_group]
        b_place = np.arange(len(self.b)) + (a_ends + 1)[b_group]
        last = np.append(self.b_doc[1:] != self.b_doc[:-1], True)[:len(self.b)]
        code = np.empty(len(self.a) + len(self.b), np.int64)
        code[a_place] = self.a + width * self.a_common
        code[b_place] = self.b + width * np.where(last, 3, 2 * self.b_common)
        text = pc.take(table, pa.array(code))
        offsets = np.frombuffer(text.buffers()[1], np.int64, len(code) + 1) if len(code) else np.zeros(1, np.int64)
        ends = np.cumsum(self.per_document(self.a_doc) + self.per_document(self.b_doc))
        view, low, found = memoryview(text.buffers()[2] or b"").cast("B"), 0, []
        for end in offsets[ends].tolist() if len(ends) else []:
            found.append(hashlib.sha256(view[low:end]).hexdigest() if end > low else "")
            low = end
        return found


def _ends(lists: pa.LargeListArray, lengths: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(ids, document, key) of every token; the key is (document, end of the token's bytes) as one number."""
    ids, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    sums = pc.cumulative_sum(pc.take(pa.array(lengths), ids)) if len(ids) else pa.array([], pa.int64())
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    before = np.append(0, sums.to_numpy(zero_copy_only=False))[np.cumsum(counts) - counts]  # the sum where a document begins
    within = pc.subtract(sums, pc.take(pa.array(before), parents)) if len(ids) else sums
    return ids, parents, pc.add(pc.multiply(parents.cast(pa.int64()), 1 << 40), within)


def align(a: pa.LargeListArray, b: pa.LargeListArray, a_lengths: np.ndarray, b_lengths: np.ndarray) -> Aligned:
    """Links and groups of documents whose lists spell the same bytes on both sides."""
    a_ids, a_doc, a_key = _ends(a, a_lengths)
    b_ids, b_doc, b_key = _ends(b, b_lengths)
    left = pa.table({"key": a_key, "at": pa.array(np.arange(len(a_ids)))})
    right = pa.table({"key": b_key, "bt": pa.array(np.arange(len(b_ids)))})
    both = left.join(right, "key", join_type="inner", use_threads=False)
    a_common, b_common = np.zeros(len(a_ids), bool), np.zeros(len(b_ids), bool)
    a_common[both["at"].to_numpy()] = True
    b_common[both["bt"].to_numpy()] = True
    # all ends of either side in order: two sorted runs merged
    b_only = np.flatnonzero(~b_common)
    keys = np.concatenate((a_key.to_numpy(), b_key.to_numpy()[b_only]))
    order = np.argsort(keys, kind="stable")
    is_a = order < len(a_ids)
    token_of = np.concatenate((a_common, np.ones(len(b_only), bool)))[order]  # where a token of B ends
    link_a, link_b = np.cumsum(is_a) - is_a, np.cumsum(token_of) - token_of
    return Aligned(len(a), a_ids.to_numpy().astype(np.int64), b_ids.to_numpy().astype(np.int64),
                   a_doc.to_numpy(), b_doc.to_numpy(), a_common, b_common, link_a, link_b)


def _aligned(batch: pa.RecordBatch, a: str, b: str, entries: Vocabulary) -> Iterator[tuple[int, int, Aligned]]:
    a_lengths, b_lengths = entries.lengths("a"), entries.lengths("b")
    a_column, b_column = batch.column(a), batch.column(b)
    for low, count in _slices(pc.binary_length(a_column).to_numpy(zero_copy_only=False)):
        yield low, count, align(_unpacked(a_column.slice(low, count)), _unpacked(b_column.slice(low, count)), a_lengths, b_lengths)


def _held(found: Aligned, width: int) -> pa.Table:
    """(doc, pair, n): each document's distinct pairs with their links."""
    links = pa.table({"doc": pa.array(found.link_docs()), "pair": pa.array(found.pairs(width))})
    return links.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])


def pair_counts(encoded: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(pair, n): in how many rows of ``encoded`` A's and B's ids are linked; the pair is a * size of B + b."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = vocabulary(a_path, b_path)
        width, partial = len(entries.b), None
        for batch in batches:
            for _, _, found in _aligned(batch, "a", "b", entries):
                counted = _held(found, width).group_by("pair", use_threads=False).aggregate([([], "count_all")])
                counted = counted.select(["pair", "count_all"]).rename_columns(["pair", "n"])
                partial = counted if partial is None else pa.concat_tables((partial, counted))
                if len(partial) >= 4 * PARTIAL_ROWS:
                    partial = _summed(partial)
                    if len(partial) >= PARTIAL_ROWS:
                        yield from partial.to_batches()
                        partial = None
        if partial is not None:
            yield from _summed(partial).to_batches()

    return encoded.select("a", "b").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _summed(counts: pa.Table) -> pa.Table:
    return counts.group_by("pair", use_threads=False).aggregate([("n", "sum")]).select(["pair", "n_sum"]).rename_columns(
        ["pair", "n"]).combine_chunks()


def _rated(counts: DataFrame, width: int) -> DataFrame:
    """(pair, n, best): best where no pair of the same A id has a higher count."""
    a = F.floor(F.col("pair") / width)
    highest = counts.groupBy(a.alias("_a")).agg(F.max("n").alias("highest"))
    return counts.join(highest, a == F.col("_a")).select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def _sent(rated: DataFrame):
    """The counts, at most some BROADCAST_BYTES, on every executor: sorted pairs, their counts, which are best."""
    counts = rated.toArrow()
    pair, n = counts["pair"].to_numpy(), counts["n"].to_numpy()
    order = np.argsort(pair)
    best = np.packbits(counts["best"].to_numpy(zero_copy_only=False)[order])
    return rated.sparkSession.sparkContext.broadcast((pair[order], n[order].astype(np.uint32 if n.max(initial=0) < 1 << 32 else np.int64), best))


def _rows(encoded: DataFrame, a_path: str, b_path: str, sent=None) -> DataFrame:
    """(row, id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256); without ``sent`` counts, no sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = vocabulary(a_path, b_path)
        width = max(len(entries.a), len(entries.b))
        table = pa.array([f"{i}{s}" for s in _SEPARATORS for i in range(width)], pa.large_string())
        if sent is not None:
            pair, n, best = sent.value
            best = np.unpackbits(best, count=len(pair)).astype(bool)
        for batch in batches:
            for low, count, found in _aligned(batch, "a", "b", entries):
                columns = [found.per_document(d) for d in (found.a_doc, found.b_doc, found.a_doc[found.a_common], found.link_docs())]
                if sent is None:
                    columns += [np.zeros(count, np.int64)] * 2
                else:
                    held, back = np.unique(found.pairs(len(entries.b)), return_inverse=True)
                    at, docs = np.searchsorted(pair, held), found.link_docs()
                    columns += [found.per_document(docs, w[at][back].astype(np.int64)) for w in (best, n)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(low, count), batch.column("id").slice(low, count),
                     *map(pa.array, columns), pa.array(found.group_digests(table, width), pa.string())],
                    ["row", "id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return encoded.select("row", "id", "a", "b").mapInArrow(
        run, f"row long, id {encoded.schema['id'].dataType.simpleString()}, n_a long, n_b long, "
             "n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _sums(encoded: DataFrame, rated: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(row, n_best, count_sum) by joining every row's distinct pairs to the counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = vocabulary(a_path, b_path)
        for batch in batches:
            for low, count, found in _aligned(batch, "a", "b", entries):
                held = _held(found, len(entries.b))
                rows = pc.take(batch.column("row").slice(low, count), held["doc"])
                yield from pa.table({"row": rows, "pair": held["pair"], "links": held["count_all"]}).to_batches()

    links = encoded.select("row", "a", "b").mapInArrow(run, "row long, pair long, links long")
    return links.join(rated, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("n")).alias("count_sum"))


def align_tokenizers(
    docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text_column: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """How tokenizer A (byte-level, ``tokenizers``) and B (``sentencepiece``) cut every text of ``docs``.

    The first table has (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each row;
    the second (a, b, n, best) says in how many rows ids a and b are linked, and whether a has no partner
    with more. Null and empty texts, and those that a tokenizer does not spell byte for byte, have no tokens:
    zeros and ''. Every row counts as a document of its own, repeated ones too. Other columns are
    not read. Counts are broadcast while their size, 12 bytes a pair, is within ``broadcast_bytes``; beyond
    that every row's pairs are joined to them by a shuffle.
    """
    spark = docs.sparkSession
    path = f"{shared_folder(spark)}/alignment-{uuid.uuid4().hex}"
    found = encode(docs, a_path, b_path, id_column, text_column)
    found.withColumn("row", F.monotonically_increasing_id()).write.option("compression", "zstd").parquet(path)
    encoded = spark.read.parquet(path)
    width = len(vocabulary(a_path, b_path).b)
    rated = materialize(_rated(materialize(pair_counts(encoded, a_path, b_path)), width))
    if 12 * rated.count() <= broadcast_bytes:
        rows = _rows(encoded, a_path, b_path, _sent(rated))
    else:
        shapes = _rows(encoded, a_path, b_path).drop("n_best", "count_sum")
        rows = shapes.join(_sums(encoded, rated, a_path, b_path), "row", "left")
    rows = rows.select("id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
                       F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
    pairs = rated.select(F.floor(F.col("pair") / width).alias("a"), (F.col("pair") % width).alias("b"), "n", "best")
    return rows, pairs
