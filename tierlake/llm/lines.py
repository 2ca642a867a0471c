"""Line deduplication across documents, exact and within one edit, through deletion neighbourhoods.

Lines are compared as whole texts; of equal ones, and of those one insertion, deletion or
substitution apart, the earliest stays. Two lines one substitution apart leave the same rest when
the character at that place is deleted; two lines one insertion apart are such that the longer
leaves the shorter. So lines give the hashes of their deletions, and equal hashes are joined.

Before that, lines that cannot have a partner are set aside without loss, first by halves, then by
eighths or finer parts: one edit leaves all parts of a line alone but one, so partners share a hash of
the others, and only characters of the part between need to be deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tierlake.operators.joins import measured_bytes
from tierlake.session import materialize

MIN_CHARS = 20
PARTS = 8                   # at least so many parts a line, and for long lines as many as a part has characters
BROADCAST_BYTES = 16 << 20  # measured size up to which rows are broadcast instead of moving texts


def _small(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if measured_bytes(rows) <= BROADCAST_BYTES else rows


def _texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return docs.select(F.col(id_column).alias("id"), text.alias("text"), F.xxhash64(text).alias("print"))


def _lines(texts: DataFrame, min_chars: int, short_repeats: bool) -> DataFrame:
    """(id, print, at, line, h) of all lines long enough or, with ``short_repeats``, not blank; h is the line's MD5."""
    wanted = F.length("line") >= min_chars
    if short_repeats:
        wanted = wanted | F.col("line").rlike(r"\S")
    return (texts.select("id", "print", F.posexplode(F.split("text", "\n")).alias("at", "line"))
            .filter(wanted).withColumn("h", F.unhex(F.md5("line"))))


def _part_keys(line: Column, parts: int, less: int) -> list[Column]:
    """Hashes of all but one of ``parts`` parts of a line that is ``less`` longer than its partner.

    Parts are those of the shorter line. What stands before the edited part is alike from the
    lines' beginnings on, what stands behind it from their ends; so lines one edit apart share the
    hash that leaves out the edited part.
    """
    shorter = F.length(line) - less
    keys = []
    for part in range(parts):
        before = F.floor(shorter * part / parts).cast("int")
        behind = (shorter - F.floor(shorter * (part + 1) / parts)).cast("int")
        keys.append(F.xxhash64(F.lit(part), shorter, F.substring(line, F.lit(1), before),
                               F.substring(line, F.length(line) - behind + 1, behind)))
    return keys


def _sharing(rows: DataFrame, keys: Column) -> DataFrame:
    """``h`` of the rows that share one of their ``keys`` with another row."""
    spread = rows.select("h", F.explode(keys).alias("key"))
    shared = spread.groupBy("key").count().filter("count > 1").select("key")
    return materialize(spread.join(shared, "key", "left_semi").select("h").distinct())


def _classes(lines: DataFrame, min_chars: int) -> DataFrame:
    """Distinct lines: (h, first, n, keys), ``first`` the smallest (id, at); lines under ``min_chars`` have no keys."""
    long = F.length("line") >= min_chars
    keyed = lines.select("h", F.struct("id", "at").alias("place"), 
                         *(F.when(long, k).alias(f"k{i}") for i, k in enumerate(_part_keys(F.col("line"), 2, 0) + _part_keys(F.col("line"), 2, 1))))
    return keyed.groupBy("h").agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("n"), *(F.max(f"k{i}").alias(f"k{i}") for i in range(4)))


def _may_have_partner(classes: DataFrame) -> DataFrame:
    """(h, first) of the classes that share a half with another class."""
    found = _sharing(classes.filter("k0 IS NOT NULL"), F.array("k0", "k1", "k2", "k3"))
    return classes.select("h", "first").join(_small(found), "h", "left_semi")


def _parts(line: Column, less: int) -> Column:
    """(less, key, before, part) of every part of a line that is ``less`` longer than its partner, as structs.

    The key is the hash of what is outside of the part, see ``_part_keys``; ``before`` counts the characters
    before it.
    """
    shorter = F.length(line) - less
    parts = F.greatest(F.lit(PARTS), F.ceil(F.sqrt(shorter)).cast("int"))

    def part(number: Column) -> Column:
        before = F.floor(shorter * number / parts).cast("int")
        behind = (shorter - F.floor(shorter * (number + 1) / parts)).cast("int")
        inside = F.length(line) - before - behind
        key = F.xxhash64(number, shorter, F.substring(line, F.lit(1), before), F.substring(line, F.length(line) - behind + 1, behind))
        return F.struct(F.lit(less).alias("less"), key.alias("key"), before.alias("before"), F.substring(line, before + 1, inside).alias("part"))

    return F.transform(F.sequence(F.lit(0), parts - 1), part)


def near_lines(lines: DataFrame, candidates: DataFrame) -> DataFrame:
    """(h, partner) for each candidate line with an earlier one exactly one edit away; one or more rows.

    ``lines`` supplies the candidates' texts. Within a group of lines that leave the same rest at the
    same place only the earliest is a partner, so rows grow with the lines and not with their pairs.
    """
    found = lines.join(_small(candidates), "h").filter(F.struct("id", "at") == F.col("first"))
    texts = materialize(found.select("h", "first", "line").dropDuplicates(["h"]))
    spread = texts.select("h", "first", F.explode(F.concat(_parts(F.col("line"), 0), _parts(F.col("line"), 1))).alias("p")).select(
        "h", "first", "p.*")
    shared = spread.groupBy("key").agg(F.min("h").alias("one"), F.max("h").alias("two")).filter("one <> two").select("key")
    spread = materialize(spread.join(shared, "key", "left_semi"))

    def deletions(mark: Column) -> Column:
        """(rest, at) with each character of the part deleted, ``at`` its place in the line."""
        return F.transform(F.sequence(F.lit(1), F.length("part")), lambda i: F.struct(
            F.xxhash64("key", F.concat(F.substring("part", F.lit(1), i - 1), mark, F.substring("part", i + 1, F.length("part")))).alias("rest"),
            (F.col("before") + i - 1).alias("at")))

    # one inserted character: the longer line's part without it is the shorter line's
    longer = spread.filter("less = 1 AND part <> ''").select("h", "first", F.explode(deletions(F.lit(""))).alias("d"))
    longer = longer.groupBy("h", "first", F.col("d.rest").alias("rest")).agg(F.min("d.at").alias("at"))
    inserted = longer.join(spread.filter("less = 0").select(
        F.col("h").alias("h2"), F.col("first").alias("first2"), F.xxhash64("key", "part").alias("rest")), "rest")
    later = F.col("first") > F.col("first2")
    inserted = inserted.filter(F.col("first") != F.col("first2")).select(
        F.when(later, F.col("h")).otherwise(F.col("h2")).alias("h"), F.when(later, F.col("h2")).otherwise(F.col("h")).alias("partner"), "at")
    # one substituted character: the same rest around the same place
    deleted = spread.filter("less = 0 AND part <> ''").select("h", "first", F.explode(deletions(F.lit("\n"))).alias("d")).select(
        "h", "first", "d.*")
    earliest = deleted.groupBy("rest").agg(
        F.min(F.struct("first", "h")).alias("lead"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    substituted = deleted.join(earliest, "rest").filter("first > lead.first").select("h", F.col("lead.h").alias("partner"), "at")
    pairs = inserted.unionAll(substituted).groupBy("h", "partner").agg(F.min("at").alias("at"), F.max("at").alias("to"))
    own, other = texts.select("h", "line"), texts.select(F.col("h").alias("partner"), F.col("line").alias("other"))
    return pairs.join(own, "h").join(other, "partner").filter(_one_edit_apart("at") | _one_edit_apart("to")).select("h", "partner")


def _one_edit_apart(at: str) -> Column:
    """Whether ``line`` and ``other`` are the same without the character at ``at``, of the longer one or of both."""
    def without(c: str) -> Column:
        return F.concat(F.substring(c, F.lit(1), F.col(at)), F.substring(c, F.col(at) + 2, F.length(c)))

    more = F.length("line") - F.length("other")
    return F.when(more == 0, without("line") == without("other")).when(more == 1, without("line") == F.col("other")).when(
        more == -1, F.col("line") == without("other")).otherwise(False)


def removed_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_chars: int = MIN_CHARS, short_repeats: bool = False,
) -> DataFrame:
    """(id, print, removed): line numbers, from 0, that go from each text that loses any.

    ``print`` is the text's XXH64. A line of at least ``min_chars`` characters goes if the same line
    has an earlier place, or if a line one edit away has: earlier is the smaller id, null first,
    then the smaller line number. Shorter lines stay, but with ``short_repeats`` those not blank go
    too if the same line has an earlier place. Rows of the same id and text fare alike.
    """
    texts = _texts(docs, id_column, text_column)
    lines = _lines(texts, min_chars, short_repeats)
    classes = materialize(_classes(lines, min_chars))
    candidates = materialize(_may_have_partner(classes))
    near = materialize(near_lines(lines, candidates).select("h").distinct().withColumn("near", F.lit(True)))
    repeated = classes.select("h", "first", "n").join(near, "h", "left").filter("n > 1 OR near").select("h", "first", "near")
    decided = _small(materialize(repeated))
    gone = lines.select("id", "print", "at", "h").join(decided, "h").filter(
        F.coalesce("near", F.lit(False)) | (F.struct("id", "at") > F.col("first")))
    return gone.groupBy("id", "print").agg(F.collect_set("at").alias("removed"))


def dedup_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_chars: int = MIN_CHARS, short_repeats: bool = False,
) -> DataFrame:
    """(doc, n_lines, n_removed): every row of ``docs`` as a struct, its text without removed lines.

    See ``removed_lines``. Null texts stay null and have no lines. All columns are kept as they are,
    whatever their names; an empty table gives an empty one.
    """
    gone = _small(materialize(removed_lines(docs, id_column, text_column, min_chars, short_repeats)))
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), F.col(id_column).alias("own"),
                       F.xxhash64(text).alias("own_print"))
    joined = rows.join(gone, F.col("own").eqNullSafe(F.col("id")) & (F.col("own_print") == F.col("print")), "left")
    # exploded from an array of one, the lines are a column of their own and not split anew for each line kept
    whole = F.coalesce(F.split(F.col("doc")[text_column], "\n"), F.array().cast("array<string>"))
    joined = joined.select("doc", "removed", F.explode(F.array(whole)).alias("lines"))
    lines = F.col("lines")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("removed"))
    shorter = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    return joined.select(
        F.when(F.col("removed").isNull(), F.col("doc")).otherwise(
            F.col("doc").withField(f"`{text_column}`", shorter)).alias("doc"),
        F.greatest(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"))
