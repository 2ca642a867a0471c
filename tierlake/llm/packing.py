"""Best-fit packing of tokenized documents into sequences, with certified bin counts.

Pieces are dealt into groups of bounded size; each group is packed best-fit decreasing. Lower
bounds from dual-feasible functions certify a group whose bin count cannot be beaten. The groups
with a gap give the documents of their unfilled sequences to a common pool, which is dealt anew and
packed again, as long as that saves sequences.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tierlake.session import materialize

CAPACITY = 1024
GROUP_ROWS = 50_000   # pieces packed by one task
ROUNDS = 4            # most exchanges; each must save sequences, so stopping early loses no document
SLICE_BYTES = 4 << 20 # text tokenized at once
WORDS_KEPT = 200_000  # distinct words whose ids a task keeps, some 200 bytes each
_IRREGULAR = "[\\s\\x{0b}\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the rest from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    """The tokenizer, and the same vocabulary for ``tiktoken`` (many times faster on single words)."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer
    tokenizer, byte_of = Tokenizer.from_file(path), _byte_of()
    ranks = {bytes(map(byte_of.__getitem__, t)): k for t, k in tokenizer.get_vocab(with_added_tokens=False).items()
             if t not in _specials(tokenizer)}
    words = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return tokenizer, words


def _specials(tokenizer) -> list[str]:
    return [t.content for t in tokenizer.get_added_tokens_decoder().values()]


def encode_batch(texts: pa.Array, path: str, known: dict[str, bytes] | None = None) -> Iterator[np.ndarray]:
    """Token ids of each text, just as the tokenizer at ``path`` gives them for the whole text.

    A byte-level tokenizer's pre-tokens end where a single space stands between two characters that
    are not white space, so texts without doubled, leading or trailing white space are split there
    and each distinct word is encoded once, by the same vocabulary and pattern. All other texts, and those that hold one of the
    tokenizer's special strings, are encoded whole. ``known`` keeps the ids of words for further batches.
    """
    tokenizer, encoder = _tokenizer(path)
    known = {} if known is None else known
    odd = pc.match_substring_regex(texts, f"{_IRREGULAR}{{2}}|^{_IRREGULAR}|{_IRREGULAR}$")
    for special in _specials(tokenizer):
        odd = pc.or_(odd, pc.match_substring(texts, special))
    odd = odd.to_numpy(zero_copy_only=False)
    plain = texts.filter(pa.array(~odd))
    pieces = pc.split_pattern(plain, " ")
    words = pieces.flatten().dictionary_encode()
    first = np.zeros(len(words), bool)
    offsets = pieces.offsets.to_numpy() - pieces.offsets[0].as_py()
    first[offsets[:-1][np.diff(offsets) > 0]] = True
    code = words.indices.to_numpy(zero_copy_only=False)
    if len(known) > WORDS_KEPT:
        known.clear()
    vocabulary = words.dictionary.to_pylist()
    opening = np.unique(code[first])
    slot = code.astype(np.int64)
    slot[first] = len(vocabulary) + np.searchsorted(opening, code[first])
    encode = encoder.encode_ordinary
    listed = []
    for word in chain((" " + w for w in vocabulary), map(vocabulary.__getitem__, opening.tolist())):
        ids = known.get(word)
        if ids is None:
            ids = known[word] = array("I", encode(word)).tobytes()
        listed.append(ids)
    flat = np.frombuffer(b"".join(listed), np.uint32)
    lengths = np.fromiter(map(len, listed), np.int64, len(listed)) // 4
    starts = np.cumsum(lengths) - lengths
    at = 0
    for text, whole in zip(texts, odd):
        if whole:
            ids = tokenizer.encode(text.as_py(), add_special_tokens=False).ids
            yield np.array(ids, np.uint32)
            continue
        own = slot[offsets[at]:offsets[at + 1]]
        at += 1
        size = lengths[own]
        ends = np.cumsum(size)
        yield flat[np.repeat(starts[own] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of some ``SLICE_BYTES`` of text, or single longer ones; memory is given back behind them."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // SLICE_BYTES
    starts = np.flatnonzero(np.append(True, part[1:] != part[:-1])[:len(part)])
    for low, high in zip(starts.tolist(), np.append(starts[1:], len(part)).tolist()):
        yield batch.slice(low, high - low)
    pa.default_memory_pool().release_unused()


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all full but for the first, which may be shorter."""
    head = length % capacity or min(length, capacity)
    return [(0, head)] + [(start, capacity) for start in range(head, length, capacity)]


def tokenized_pieces(
    docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text", end_id: int = 2,
    capacity: int = CAPACITY, keep_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): every document's token ids, cut to ``capacity``.

    Each document is its text's ids, then ``end_id``, so a null or empty text is one piece of one id.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bytes] = {}
        for batch in chain.from_iterable(map(_slices, batches)):
            texts = pc.fill_null(batch.column(1), "")
            rows, numbers, starts, lengths, sums, held = [], [], [], [], [], []
            for row, ids in enumerate(encode_batch(texts, tokenizer_path, known)):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for number, (start, length) in enumerate(cut(len(ids), capacity)):
                    own = ids[start:start + length]
                    rows.append(row)
                    numbers.append(number)
                    starts.append(start)
                    lengths.append(length)
                    sums.append(zlib.crc32(own.tobytes()))
                    if keep_ids:
                        held.append(own.astype(np.int32))
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()),
                       pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(held, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    extra = ", ids array<int>" if keep_ids else ""
    return source.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long{extra}")


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Best-fit decreasing: (bin, offset) of each length and the number of bins.

    Open bins are kept by free space; the bits of one integer say which spaces have a bin.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces, count = 0, 0
    for at in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[at])
        fitting = spaces >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            own = free[space].pop()
            if not free[space]:
                spaces &= ~(1 << space)
        else:
            own, space, count = count, capacity, count + 1
        bins[at], offsets[at] = own, capacity - space
        left = space - length
        if left:
            free[left].append(own)
            spaces |= 1 << left
    return bins, offsets, count


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins: the largest total under several dual-feasible functions.

    With f such a function, lengths that fit one bin have values that sum to one at most, so the
    sum over all lengths bounds the bins from below. Used: the volume; for each t, lengths over
    capacity - t count whole and those under t nothing; for each k, (k + 1) x / capacity rounded
    down and divided by k unless it is a whole number.
    """
    counts = np.bincount(lengths, minlength=capacity + 1)
    size = np.arange(capacity + 1)
    best = -(-int(counts @ size) // capacity)
    for t in range(1, capacity // 2 + 1):
        value = np.where(size > capacity - t, capacity, np.where(size < t, 0, size))
        best = max(best, -(-int(counts @ value) // capacity))
    for k in range(1, 101):
        scaled = size * (k + 1)
        value = np.where(scaled % capacity == 0, size * k, scaled // capacity * capacity)
        best = max(best, -(-int(counts @ value) // (capacity * k)))
    return best


def _pack_groups(pieces: DataFrame, capacity: int, group_rows: int, round_number: int) -> DataFrame:
    """Deal pieces into groups and pack each: adds grp, bin, offset, filled, certified."""
    rows = pieces.count()
    groups = max(1, -(-rows // group_rows))
    kinds = {f.name: f.dataType.simpleString() for f in pieces.schema.fields}

    def pack(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        bins, offsets, count = best_fit(lengths, capacity)
        filled = np.bincount(bins, weights=lengths, minlength=count).astype(np.int64)
        certified = count == lower_bound(lengths, capacity)
        return (table.append_column("bin", pa.array(bins)).append_column("offset", pa.array(offsets))
                .append_column("filled", pa.array(filled[bins]))
                .append_column("certified", pa.array(np.full(len(bins), certified))))

    dealt = pieces.withColumn("grp", F.pmod(F.monotonically_increasing_id(), F.lit(groups)))
    schema = ", ".join(f"`{n}` {k}" for n, k in kinds.items())
    packed = dealt.groupBy("grp").applyInArrow(
        pack, f"{schema}, grp long, bin long, offset long, filled long, certified boolean")
    return packed.withColumn("round", F.lit(round_number))


def _bins(packed: DataFrame) -> int:
    return packed.filter("offset = 0").count()


def pack_sequences(
    pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, rounds: int = ROUNDS,
) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to ``pieces(…, length)``, lengths from 1 to ``capacity``.

    Every row gets a place, repeated rows a place each; offsets are gapless from 0 within a
    sequence. Full pieces are sequences by themselves and move nowhere. The columns grp, bin,
    offset, filled, certified, round and sequence_id must not be among those of ``pieces``.
    """
    names = pieces.columns
    pieces = materialize(pieces)
    full = pieces.filter(F.col("length") == capacity).withColumns({
        "sequence_id": -F.monotonically_increasing_id() - 1, "offset": F.lit(0).cast("long")})
    packed = materialize(_pack_groups(pieces.filter(F.col("length") < capacity), capacity, group_rows, 0))
    settled: list[DataFrame] = []
    for number in range(1, rounds + 1):
        open_ = ~F.col("certified") & (F.col("filled") < capacity)
        pool = packed.filter(open_)
        before = _bins(pool)
        if before < 2:
            break
        again = materialize(_pack_groups(pool.select(names), capacity, group_rows, number))
        if _bins(again) >= before:
            break
        settled.append(packed.filter(~open_))
        packed = again
    place = F.col("round") * F.lit(1 << 56) + F.col("grp") * F.lit(1 << 24) + F.col("bin")
    result = full.select(*names, "sequence_id", "offset")
    for part in [*settled, packed]:
        result = result.unionAll(part.select(*names, place.alias("sequence_id"), "offset"))
    return result


def pack_documents(
    docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text", end_id: int = 2,
    capacity: int = CAPACITY, keep_ids: bool = False,
) -> DataFrame:
    """Tokenize, cut and pack: (id, piece, start, length, ids_crc32[, ids], sequence_id, offset)."""
    return pack_sequences(
        tokenized_pieces(docs, tokenizer_path, id_column, text_column, end_id, capacity, keep_ids), capacity)
