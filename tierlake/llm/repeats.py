"""Removal of repeated byte strings through a content-defined parse of all texts.

Every string of ``length`` bytes has a trigger: the 32-byte gram with the least rolling hash in it, so
equal strings have theirs at the same place. Neighbouring strings with the same trigger are one
phrase, the bytes from the first of them to the end of the last. The texts become a parse, the places
of phrases, over a dictionary, the distinct phrases; each phrase holds whole strings, so no order of
the parse beyond a phrase is needed to compare strings of bounded length.

* The parse is sorted by trigger, phrase and place. All places of a phrase but the first repeat it.
* Different phrases share strings only if they share their trigger. The phrases of such a trigger meet,
  and their strings, the suffixes of that part of the dictionary cut at ``length`` bytes, are put in
  corpus order: a suffix array by part, where a string equal to the one before it repeats it. The
  strings of triggers with more phrases than one task should hold are range sorted over all tasks.

Of what a batch of texts holds several times only the earliest place enters a sort, and a trigger with
several phrases in a batch enters the first sort as a shared one alone. So a phrase, trigger or
string that a third of all texts has makes one row for each batch, not for each text.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tierlake.session import materialize, shared_folder

LENGTH = 100
GRAM = 32
SENT_GRAMS = 4 << 20     # shared triggers, 8 bytes each, up to which every task gets them all; beyond it they are joined
MET_PHRASES = 4096      # most phrases of a trigger that meet in one task, some 170 bytes each
_MANY = 64               # places of a phrase from which they are counted for that
_AT_ONCE = 1 << 20       # bytes parsed in one step
_HIGH = np.uint64((1 << 64) - (1 << 24))


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


class _Roller:
    """Hashes of any stretch of a buffer, polynomial in a base over random codes of bytes."""

    def __init__(self, base: int):
        self.step, self.back = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.codes = _mix(np.arange(256, dtype=np.uint64) * np.uint64(base) + np.uint64(1))
        self.powers = self.backs = np.ones(1, np.uint64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(self.powers) <= len(data):
            size = max(len(data), _AT_ONCE) + 1
            self.powers, self.backs = (np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size, x)))) for x in (self.step, self.back))
        return np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.codes[data] * self.powers[:len(data)])))

    def hashes(self, sums: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return _mix((sums[high] - sums[low]) * self.backs[low])


def _rollers() -> tuple[_Roller, _Roller]:
    return _Roller(0x9E3779B97F4A7C15), _Roller(0xD1342543DE82EF95)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    return np.minimum(values[:len(values) - width + done], values[width - done:]) if done < width else values


def _phrases(data: np.ndarray, ends: np.ndarray, length: int, gram: int, rollers) -> tuple[np.ndarray, ...]:
    """(trigger hash, phrase hash, first start, stop of starts) of the phrases of texts that end at ``ends``."""
    first, second = rollers
    sums, n_grams = first.sums(data), len(data) - gram + 1
    grams = _mix((sums[gram:] - sums[:-gram]) * first.backs[:n_grams])
    places = np.arange(n_grams, dtype=np.uint64)
    trigger = (_least((grams & _HIGH) | places, length - gram + 1) & ~_HIGH).astype(np.int64)
    crossing = np.zeros(len(data) + 1, np.int64)  # strings that run over a text's end
    crossing[ends[:-1] - length + 1] += 1
    crossing[ends[:-1]] -= 1
    whole = np.cumsum(crossing)[:len(trigger)] == 0
    low = np.flatnonzero(np.append(True, (trigger[1:] != trigger[:-1]) | (whole[1:] != whole[:-1])))
    high = np.append(low[1:], len(trigger))
    low, high = low[whole[low]], high[whole[low]]
    return grams[trigger[low]], second.hashes(second.sums(data), low, high - 1 + length), low, high


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8), offsets


def _parse(batch: pa.RecordBatch, length: int, gram: int, rollers) -> dict[str, np.ndarray]:
    """All phrases of a batch of (id, print, text): trigger, phrase, row, and the range of starts in the text.

    Short texts are parsed together, long ones in parts that overlap by ``length`` - 1 bytes.
    """
    data, offsets = _bytes(batch.column(2))
    found, held, size = [], [], 0

    def parse_held():
        ends = np.cumsum([len(part) for part, _, _ in held])
        rows, shifts = (np.array([h[k] for h in held]) for k in (1, 2))
        trigger, phrase, low, high = _phrases(np.concatenate([h[0] for h in held]), ends, length, gram, rollers)
        at = np.searchsorted(ends, low, "right")
        shift = shifts[at] - np.append(0, ends[:-1])[at]
        found.append((trigger, phrase, rows[at], low + shift, high + shift))

    for row in range(len(batch)):
        text = data[offsets[row]:offsets[row + 1]]
        for low in range(0, len(text) - length + 1, _AT_ONCE):
            part = text[low:low + _AT_ONCE + length - 1]
            if held and size + len(part) > _AT_ONCE + length:
                parse_held()
                held, size = [], 0
            held.append((part, row, low))
            size += len(part)
    if held:
        parse_held()
    names = ("trigger", "phrase", "row", "start", "stop")
    if not found:
        return {n: np.zeros(0, np.uint64 if n in names[:2] else np.int64) for n in names}
    return dict(zip(names, map(np.concatenate, zip(*found))))


def _ranks(ids: pa.Array) -> np.ndarray:
    """The order of ids, nulls first, equal ones alike."""
    distinct = ids.dictionary_encode("encode")
    order = np.empty(len(distinct.dictionary), np.int64)
    order[pc.sort_indices(distinct.dictionary, null_placement="at_start").to_numpy()] = np.arange(len(order))
    return order[distinct.indices.to_numpy()]


def _in_order(keys: list[np.ndarray], batch: pa.RecordBatch, row: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, ...]:
    """(order, new, later, kept) by key and place, for rows of a batch of (id, print, ...).

    Of each place in that order: whether its key is new, whether that has an earlier place, and whether
    the place is to be kept, as neither that nor the same place of the same text has been before.
    """
    rank, prints = _ranks(batch.column(0))[row], batch.column(1).to_numpy()[row]
    order = np.lexsort((prints, start, rank, *reversed(keys)))
    new, fresh = (np.logical_or.reduce([np.append(True, k[order][1:] != k[order][:-1])[:len(order)] for k in ks])
                  for ks in (keys, [*keys, rank, start, prints]))
    lead = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    later = (rank[order] > rank[lead]) | (start[order] > start[lead])
    return order, new, later, fresh & ~later


def _merged(row: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of a row that touch or overlap, as one."""
    order = np.lexsort((start, row))
    row, start, stop = row[order], start[order], stop[order]
    if not len(row):
        return row, start, stop
    reach = np.maximum.accumulate(row * (1 << 40) + stop)
    at = np.flatnonzero(np.append(True, row[1:] * (1 << 40) + start[1:] > reach[:-1]))
    return row[at], start[at], reach[np.append(at[1:], len(row)) - 1] - row[at] * (1 << 40)


def _rows(batch: pa.RecordBatch, kind: int, row: np.ndarray, first: pa.Array, second: np.ndarray, start, stop) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(row), kind, np.int32)), first, pa.array(second), batch.column(0).take(pa.array(row)),
         batch.column(1).take(pa.array(row)), pa.array(start), pa.array(stop)],
        ["kind", "k1", "k2", "id", "print", "start", "stop"])


#: Kinds of rows: places to sort, ranges known to repeat an earlier place, triggers of several phrases.
_PLACE, _AGAIN, _SHARED = 0, 1, 2


def _again(batch: pa.RecordBatch, row: np.ndarray, start: np.ndarray, stop: np.ndarray, raw: bool) -> pa.RecordBatch:
    """Ranges that no other row has to meet, dealt out by keys made from their places."""
    row, start, stop = _merged(row, start, stop)
    keys = _mix(row.astype(np.uint64) << np.uint64(32) ^ start.astype(np.uint64))
    first = pa.array([k.tobytes() for k in keys], pa.binary()) if raw else pa.array(keys.view(np.int64))
    return _rows(batch, _AGAIN, row, first, np.zeros(len(row), np.int64), start, stop)


def _schema(key: str, id_type: str) -> str:
    return f"kind int, k1 {key}, k2 long, id {id_type}, print long, start long, stop long"


def phrase_places(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """The parse of ``texts(id, print, text)``: k1 the trigger, k2 the phrase, and its range of starts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rollers = _rollers()
        for batch in batches:
            found = _parse(batch, length, gram, rollers)
            order, new, later, kept = _in_order([found["trigger"], found["phrase"]], batch, found["row"], found["start"])
            trigger, phrase, row, start, stop = (found[n][order] for n in ("trigger", "phrase", "row", "start", "stop"))
            yield _again(batch, row[later], start[later], stop[later], False)
            own = np.append(True, trigger[1:] != trigger[:-1])[:len(trigger)]  # where a trigger begins
            group = np.cumsum(own) - 1
            size = np.bincount(group[new], minlength=1)  # phrases of each trigger
            at = np.flatnonzero(own & (size[group] > 1))
            yield _rows(batch, _SHARED, row[at], pa.array(trigger[at].view(np.int64)), size[group[at]], start[at], stop[at])
            alone = np.flatnonzero(kept & (size[group] == 1))
            alone = alone[np.lexsort((start[alone], row[alone]))]  # neighbours in the text make small blocks
            yield _rows(batch, _PLACE, row[alone], pa.array(trigger[alone].view(np.int64)), phrase[alone].view(np.int64),
                        start[alone], stop[alone])

    return texts.mapInArrow(run, _schema("long", texts.schema["id"].dataType.simpleString()))


def shared_phrases(texts: DataFrame, shared: DataFrame, length: int, gram: int) -> DataFrame:
    """(trigger, id, print, start, piece): phrases whose trigger is in ``shared(trigger)``, with their bytes.

    Of the places that a batch has for a phrase only the earliest: the others repeat it.
    """
    id_type = texts.schema["id"].dataType.simpleString()
    few = shared.count() <= SENT_GRAMS
    sent = texts.sparkSession.sparkContext.broadcast(
        np.sort(shared.toArrow()["trigger"].to_numpy().astype(np.int64))) if few else None

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rollers = _rollers()
        for batch in batches:
            found = _parse(batch, length, gram, rollers)
            if sent is not None:
                known, trigger = sent.value, found["trigger"].view(np.int64)
                at = np.minimum(np.searchsorted(known, trigger), max(len(known) - 1, 0))
                hit = known[at] == trigger if len(known) else np.zeros(len(at), bool)
                found = {n: v[hit] for n, v in found.items()}
            order, _, _, kept = _in_order([found["trigger"], found["phrase"]], batch, found["row"], found["start"])
            at = np.sort(order[kept])  # the others of the batch are repeats already
            trigger, row, start, stop = (found[n][at] for n in ("trigger", "row", "start", "stop"))
            data, offsets = _bytes(batch.column(2))
            held = [data[a:b].tobytes() for a, b in zip((offsets[row] + start).tolist(), (offsets[row] + stop - 1 + length).tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(trigger.view(np.int64)), batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)),
                 pa.array(start), pa.array(held, pa.binary())], ["trigger", "id", "print", "start", "piece"])

    rows = texts.mapInArrow(pieces, f"trigger long, id {id_type}, print long, start long, piece binary")
    return rows if few else rows.join(shared, "trigger", "left_semi")


def _suffixes(batch: pa.RecordBatch, length: int):
    """(rows, strings, starts, later, kept) of all strings of phrases (id, print, start, piece) in corpus order."""
    data, offsets = _bytes(batch.column(3))
    size = np.diff(offsets) - length + 1
    row = np.repeat(np.arange(len(batch)), size)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    strings = np.lib.stride_tricks.sliding_window_view(data, length)[offsets[row] + inside].view(f"S{length}").reshape(-1)
    start = batch.column(2).to_numpy()[row] + inside
    order, _, later, kept = _in_order([strings], batch, row, start)
    return row[order], strings[order], start[order], later, kept


def repeats_in_triggers(phrases: DataFrame, length: int) -> DataFrame:
    """(id, print, start, stop) where a string of a trigger's phrases has an earlier place; phrases lie by trigger."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # phrases of the last trigger, which may go on
        for batch in chain(batches, [None]):
            if batch is not None and not len(batch):
                continue
            parts = [b for b in (held, batch) if b is not None]
            if not parts:
                return
            whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            trigger = whole.column(0).to_numpy()
            end = len(whole) if batch is None else int(np.searchsorted(trigger, trigger[-1]))
            held = whole.slice(end)
            for low, high in _parts(trigger[:end]):
                part = whole.slice(low, high - low).select(["id", "print", "start", "piece"])
                row, _, start, later, _ = _suffixes(part, length)
                yield _again(part, row[later], start[later], start[later] + 1, True).select(["id", "print", "start", "stop"])

    return phrases.mapInArrow(run, f"id {phrases.schema['id'].dataType.simpleString()}, print long, start long, stop long")


def _parts(trigger: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows of whole triggers, some ``MET_PHRASES`` rows each."""
    ends = np.append(np.flatnonzero(trigger[1:] != trigger[:-1]) + 1, len(trigger)) if len(trigger) else trigger
    low = 0
    for end in ends.tolist():
        if end - low >= MET_PHRASES or end == len(trigger):
            yield low, end
            low = end


def strings_of(phrases: DataFrame, length: int) -> DataFrame:
    """The places of all strings of ``phrases``, to be range sorted; k1 has the string's bytes."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            row, strings, start, later, kept = _suffixes(batch, length)
            yield _again(batch, row[later], start[later], start[later] + 1, True)
            row, strings, start = row[kept], strings[kept], start[kept]
            raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(length), len(row), [None, pa.py_buffer(strings.tobytes())])
            yield _rows(batch, _PLACE, row, raw.cast(pa.binary()), np.zeros(len(row), np.int64), start, start + 1)

    rows = phrases.select("id", "print", "start", "piece")
    return rows.mapInArrow(cut, _schema("binary", rows.schema["id"].dataType.simpleString()))


def repeated_ranges(places: DataFrame) -> DataFrame:
    """(trigger, id, print, start, stop) from sorted places: ranges of starts that repeat an earlier place.

    Rows with a trigger instead say that it has several phrases, ``stop`` more of them, or, where ``start``
    is 0, that there are ``stop`` more places of its phrases. Works along each partition in order and keeps
    only the row before.
    """
    schema = places.schema
    key = schema["k1"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, moved = None, False  # the last row, and whether it has another place than its key's first row
        for batch in batches:
            if not len(batch):
                continue
            whole = pa.Table.from_batches([b for b in (before, batch) if b is not None]).combine_chunks().to_batches()[0]
            skip = len(whole) - len(batch)
            n = len(whole)

            def differs(name):
                column = whole.column(name)
                if not column.null_count:
                    return pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
                codes = column.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
                return codes[1:] != codes[:-1]

            kind = whole.column("kind").to_numpy()
            other_trigger = np.append(True, differs("k1") | (kind[1:] != kind[:-1]))
            other = other_trigger | np.append(True, differs("k2"))
            place = np.append(False, differs("id") | differs("start")) & ~other
            changes = np.cumsum(place)
            head = np.maximum.accumulate(np.where(other, np.arange(n), 0))
            later = changes > changes[head]
            if skip and moved:
                later |= head == 0
            moved = bool(later[-1])
            again = np.flatnonzero((kind == _AGAIN) | ((kind == _PLACE) & later))
            again = pa.array(again[again >= skip])
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(again), pa.int64()), *(whole.column(c).take(again) for c in ("id", "print", "start", "stop"))],
                ["trigger", "id", "print", "start", "stop"])
            if key == "bigint":
                several = (kind == _SHARED) | ((kind == _PLACE) & other & ~other_trigger)
                several[:skip] = False
                runs = np.flatnonzero(other_trigger)
                counts = np.diff(np.append(runs, n))
                many = runs[(counts >= _MANY) & (kind[runs] == _PLACE)]
                at = np.concatenate((np.flatnonzero(several), many))
                more = np.concatenate((np.where(kind == _SHARED, whole.column("k2").to_numpy(), 1)[several],
                                       counts[(counts >= _MANY) & (kind[runs] == _PLACE)]))
                sure = np.concatenate((np.ones(int(several.sum()), np.int64), np.zeros(len(many), np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [whole.column("k1").take(pa.array(at)), pa.nulls(len(at), whole.column("id").type), pa.nulls(len(at), pa.int64()),
                     pa.array(sure), pa.array(more)], ["trigger", "id", "print", "start", "stop"])
            before = whole.slice(n - 1, 1)

    return places.mapInArrow(scan, f"trigger long, id {schema['id'].dataType.simpleString()}, print long, start long, stop long")


def repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(id, print, start, stop): the strings of ``length`` bytes that start at ``start`` up to before ``stop`` stand earlier too.

    Ranges may overlap. Earlier is the smaller id, null first, then the earlier start in the text; rows of
    the same id count as one document. ``print`` is the text's XXH64.
    """
    if not 8 <= gram <= length:
        raise ValueError("a trigger has at least 8 bytes and fits into a string")
    spark = docs.sparkSession
    texts = _texts(docs, id_column, text_column).filter(F.octet_length("text") >= length)
    texts = texts.select("id", "print", F.col("text").cast("binary").alias("text"))
    order = ("kind", "k1", "k2", "id", "start")
    parse = phrase_places(texts, length, gram)
    known = materialize(repeated_ranges(parse.repartition("k1").sortWithinPartitions(*order)))
    shared = materialize(known.filter("trigger IS NOT NULL").groupBy("trigger").agg(
        F.max("start").alias("sure"), F.sum("stop").alias("n")).filter("sure = 1").drop("sure"))
    folder = f"{shared_folder(spark)}/repeats-{uuid.uuid4().hex}"
    phrases = shared_phrases(texts, shared.select("trigger"), length, gram)
    hot = shared.filter(F.col("n") > MET_PHRASES).select("trigger", F.lit(True).alias("hot"))
    hot = F.broadcast(hot) if hot.count() <= SENT_GRAMS else hot  # 9 bytes each
    phrases.join(hot, "trigger", "left").write.option("compression", "zstd").parquet(f"{folder}/phrases")
    phrases = spark.read.parquet(f"{folder}/phrases")
    met = phrases.filter("hot IS NULL").drop("hot").repartition("trigger").sortWithinPartitions("trigger")
    strings_of(phrases.filter("hot"), length).write.option("compression", "zstd").parquet(f"{folder}/strings")  # sampled, then sorted
    strings = spark.read.schema(_schema("binary", texts.schema["id"].dataType.simpleString())).parquet(f"{folder}/strings")
    found = repeats_in_triggers(met, length).unionAll(
        repeated_ranges(strings.repartitionByRange("k1").sortWithinPartitions(*order)).drop("trigger"))
    return known.filter("trigger IS NULL").drop("trigger").unionAll(found)


def _texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("print"), text.alias("text"))


def without_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH, gram: int = GRAM,
) -> DataFrame:
    """(id, kept, n_bytes, spans) of every row of ``docs``: its bytes without those in a string that stands earlier.

    A byte goes if any string of ``length`` bytes over it also starts earlier (see ``repeats``) in the
    texts as given; strings never cross texts. ``kept`` is binary, since a character may be cut;
    ``spans`` are the maximal removed runs as structs of start and stop. Null and empty texts are empty,
    texts shorter than ``length`` whole. Rows of the same id and text fare alike, other columns are not
    read, an empty table gives an empty one.
    """
    ranges = repeats(docs, id_column, text_column, length, gram)
    of_text = materialize(ranges.groupBy("id", "print").agg(F.collect_list(F.struct("start", "stop")).alias("ranges")))
    of_text = of_text.toDF("own", "own_print", "ranges")
    texts = _texts(docs, id_column, text_column)
    rows = texts.join(of_text, F.col("id").eqNullSafe(F.col("own")) & (F.col("print") == F.col("own_print")), "left")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
        for batch in batches:
            kept, sizes, spans = [], [], []
            for text, ranges in zip(batch.column(1), batch.column(2)):
                text, own, gone = text.as_py(), [], ranges.values
                if gone is not None:
                    start, stop = (gone.field(k).to_numpy() for k in (0, 1))
                    _, start, stop = _merged(np.zeros(len(start), np.int64), start, stop - 1 + length)
                    own = list(zip(start.tolist(), stop.tolist()))
                low, parts = 0, []
                for a, b in own:
                    parts.append(text[low:a])
                    low = b
                kept.append(b"".join((*parts, text[low:])))
                sizes.append(len(text))
                spans.append([{"start": a, "stop": b} for a, b in own])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(span))],
                ["id", "kept", "n_bytes", "spans"])

    rows = rows.select("id", F.col("text").cast("binary").alias("text"), "ranges")
    return rows.mapInArrow(remove, f"id {rows.schema['id'].dataType.simpleString()}, kept binary, n_bytes long, "
                                   "spans array<struct<start:long,stop:long>>")
