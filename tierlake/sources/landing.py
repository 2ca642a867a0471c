"""Bronze: raw JSON, JSONL and CSV files landed as one append-only record table.

Each row is one record: its JSON text, where it stood, and the tags of its file. The table
is partitioned by source, year, month and day (zero padded).
"""

from __future__ import annotations

import csv
import hashlib
from collections.abc import Iterable, Iterator
from datetime import date, datetime, timezone
from urllib.parse import unquote

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions import payload as P
from tierlake.functions.columns import named
from tierlake.functions.paths import PARTITIONS, as_date, object_key, parse_key, partition_filter, partition_values
from tierlake.operators.joins import lookup_join
from tierlake.session import materialize
from tierlake.sources.folders import empty_files, exists, source_folders

BRONZE_SCHEMA = (
    T.StructType()
    .add("payload", T.StringType())
    .add("_source_file", T.StringType())
    .add("_content_md5", T.StringType())
    .add("_file_hash", T.StringType())
    .add("_block_pos", T.LongType())
    .add("_row_pos", T.LongType())
    .add("_original_format", T.StringType())
    .add("_schema_version", T.StringType())
    .add("_ingestion_timestamp", T.TimestampType())
    .add("source", T.StringType())
    .add("year", T.IntegerType())
    .add("month", T.IntegerType())
    .add("day", T.IntegerType())
)
FILE_ORDER = ("_source_file", "_block_pos", "_row_pos")
WHOLE_FILE_BYTES = 256 << 20
# Hadoop's names of stores that Arrow knows by another one.
_ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}
EMPTY_MD5 = hashlib.md5(b"", usedforsecurity=False).hexdigest()


def _moment(at: datetime | None) -> datetime:
    """Aware UTC instant; a naive one is taken as UTC."""
    if at is None:
        return datetime.now(timezone.utc)
    return at.astimezone(timezone.utc) if at.tzinfo else at.replace(tzinfo=timezone.utc)


def _wall_clock(moment: datetime) -> Column:
    """UTC wall clock of the instant, whatever the session's time zone."""
    return F.lit(f"{moment:%Y-%m-%d %H:%M:%S}").cast("timestamp_ntz")


def bronze_path(root: str, table: str) -> str:
    return f"{root}/bronze/{table}"


def read_bronze(
    spark: SparkSession,
    root: str,
    table: str,
    start: date | datetime | None = None,
    end: date | datetime | None = None,
    source: str | None = None,
) -> DataFrame:
    """Landed records; date range and source prune partitions."""
    folders = _folders(spark, root, table, start, end, source)
    if not folders:
        return spark.createDataFrame([], BRONZE_SCHEMA)
    # the declared schema keeps a source such as "007" text
    reader = spark.read.schema(BRONZE_SCHEMA).option("basePath", bronze_path(root, table))
    return reader.parquet(*map(_literal, folders)).where(partition_filter(start, end, source))


def _folders(spark, root, table, start, end, source) -> list[str]:
    base = bronze_path(root, table)
    if source:
        return source_folders(spark, base, source, as_date(start), as_date(end))
    return [base] if exists(spark, base) else []


def _md5_in_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    for batch in batches:
        digests = []
        for path in batch["_path"]:
            scheme, rest = path.split(":", 1)
            system, name = fs.FileSystem.from_uri(f"{_ARROW_SCHEMES.get(scheme, scheme)}:{rest}")
            digest = hashlib.md5(usedforsecurity=False)
            with system.open_input_stream(name) as stream:
                while chunk := stream.read(1 << 20):
                    digest.update(chunk)
            digests.append(digest.hexdigest())
        yield batch.assign(_content_md5=digests)[["_path", "_content_md5"]]


def hash_files(spark: SparkSession, paths: list[str], whole_file_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """MD5 of every file. Files too big for one value are streamed through their task in chunks."""
    files = spark.read.format("binaryFile").load(paths).withColumn("_path", F.col("_metadata.file_path"))
    small = files.where(F.col("length") <= whole_file_bytes).select("_path", F.md5("content").alias("_content_md5"))
    large = files.where(F.col("length") > whole_file_bytes).select("_path")
    hashed = small.unionByName(large.mapInPandas(_md5_in_chunks, "_path string, _content_md5 string"))
    empty = [(path, EMPTY_MD5) for path in empty_files(spark, paths)]
    return hashed.unionByName(spark.createDataFrame(empty, hashed.schema)) if empty else hashed


def _file_name(path: Column) -> Column:
    encoded = F.element_at(F.split(path, "/"), -1)
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))


def _stem(name: Column) -> Column:
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def _suffix(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r".\.([^.]*)$", 1))


def _positioned(df: DataFrame, payload: Column) -> DataFrame:
    """Record with its place in the file: start of the split, then row number within it."""
    return df.select(
        payload.alias("payload"),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block_pos"),
        F.monotonically_increasing_id().alias("_row_pos"),
    )


def _jsonl_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    lines = spark.read.text(paths, lineSep="\n")
    return _positioned(lines, F.col("value")).where(F.trim(F.translate("payload", "\r\t", "  ")) != "")


def _whole_texts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Each file's text as one value, for what cannot be split; such a file is one task."""
    return spark.read.text(paths, wholetext=True).select("value", F.col("_metadata.file_path").alias("_path"))


def _records_of(texts: DataFrame, split: Column) -> DataFrame:
    return texts.select("_path", F.lit(0).cast("long").alias("_block_pos"), F.posexplode(split).alias("_row_pos", "payload")).select(
        "payload", "_path", "_block_pos", F.col("_row_pos").cast("long").alias("_row_pos"))


def _json_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Arrays or single objects; a file that isn't exactly one JSON document is refused."""
    texts = _whole_texts(spark, paths)
    bad = texts.where(~P.is_one_document(F.col("value"))).select("_path").limit(5)
    found = [r["_path"] for r in bad.collect()]
    if found:
        raise ValueError(f"not one JSON document (name JSON lines .jsonl): {', '.join(found)}")
    return _records_of(texts, P.records(F.col("value"), F.lit("json")))


def _csv_profile(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Per file its header line and whether some line needs the whole file to be read."""
    text = _positioned(spark.read.text(paths, lineSep="\n"), F.rtrim(F.translate("value", "\r", " ")))
    text = text.where(F.trim("payload") != "")
    return text.groupBy("_path").agg(
        F.min_by("payload", F.struct("_block_pos", "_row_pos")).alias("header"),
        F.max(P.needs_whole_file(F.col("payload"))).alias("whole"),
    )


def _csv_records(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """One reader per distinct header, so that files may differ in columns.

    A file whose quoted cells all end on their line is split by lines over many tasks; the others
    are read whole, by the routine that payloads go through. Either way short rows are padded with
    nulls, empty cells are null, and a row longer than its header raises.
    """
    groups: dict[str | None, list[str]] = {}
    # one row per file of this call, which the driver has listed already
    for row in _csv_profile(spark, paths).toLocalIterator():
        groups.setdefault(None if row["whole"] else row["header"], []).append(row["_path"])
    frames = []
    whole = groups.pop(None, None)
    if whole:
        frames.append(_records_of(_whole_texts(spark, [_decoded(m) for m in whole]), P.csv_records(F.col("value"))))
    for header, members in sorted(groups.items()):
        names = P.unique_names(next(csv.reader([header])))
        bad = "_malformed_row"
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, bad]])
        rows = (
            spark.read.schema(schema)
            .options(header=True, quote='"', escape='"', mode="PERMISSIVE",
                     columnNameOfCorruptRecord=bad, enforceSchema=True, maxCharsPerColumn=-1)
            .csv([_decoded(m) for m in members])
        )
        fields = F.size(F.split(P.without_quoted_cells(named(bad)), ",", -1))
        cells = [F.nullif(named(n), F.lit("")).alias(n) for n in names]
        record = F.to_json(F.struct(*cells), {"ignoreNullFields": "false"})
        too_long = named(bad).isNotNull() & (fields > len(names))
        message = F.concat(F.lit("CSV row longer than its header: "), named(bad))
        frames.append(_positioned(rows, F.when(too_long, F.raise_error(message)).otherwise(record)))
    return frames


def _literal(path: str) -> str:
    """Reader argument that names exactly this path: readers treat some signs as globs."""
    return "".join(f"\\{ch}" if ch in "{}[]*?\\" else ch for ch in path)


def _decoded(uri: str) -> str:
    return _literal(unquote(uri))


def _append(records: DataFrame, root: str, table: str) -> None:
    records.write.mode("append").partitionBy(*PARTITIONS).option("compression", "snappy").parquet(
        bronze_path(root, table))


def _landed(spark: SparkSession, root: str, table: str, source: str, at: datetime) -> DataFrame:
    """Files already landed today from this source: one row per file, from two columns."""
    today = read_bronze(spark, root, table, at, at, source)
    return today.select("_source_file", "_content_md5").distinct()


def not_landed(files: DataFrame, landed: DataFrame) -> DataFrame:
    """Files whose key and content are not there yet."""
    return files.join(landed, ["_source_file", "_content_md5"], "left_anti")


def _result(spark: SparkSession, files: DataFrame, root: str, table: str, source: str, at: datetime,
            version: str) -> DataFrame:
    counts = (
        read_bronze(spark, root, table, at, at, source)
        .groupBy("_source_file", "_content_md5").agg(F.count(F.lit(1)).alias("record_count"))
    )
    return files.join(counts, ["_source_file", "_content_md5"], "left").select(
        F.concat(F.lit(f"{root}/"), "_source_file").alias("location"),
        F.col("_source_file").alias("key"),
        F.coalesce("record_count", F.lit(0)).alias("record_count"),
        F.substring("_content_md5", 1, 8).alias("file_hash"),
        F.lit(at).alias("ingestion_timestamp"),
        F.lit(source).alias("source"),
        F.lit(version).alias("schema_version"),
        F.col("_format").alias("original_format"),
    )


def ingest_files(
    spark: SparkSession,
    root: str,
    table: str,
    source: str,
    paths: str | Iterable[str],
    schema_version: str = "1.0",
    at: datetime | None = None,
) -> DataFrame:
    """Land files (or folders of files); one result row per file.

    Content that already landed from this source today under this name is left as it is.
    """
    moment = _moment(at)
    wanted = [paths] if isinstance(paths, str) else list(paths)
    try:
        hashed = hash_files(spark, wanted)
    except AnalysisException as error:
        raise FileNotFoundError(str(error)) from error
    name = _file_name(F.col("_path"))
    facts = materialize(hashed.select("_path", "_content_md5", _stem(name).alias("_stem"), _suffix(name).alias("_format")))
    others = facts.where(~F.col("_format").isin(*P.FORMATS)).select("_format").distinct().limit(10)
    unknown = sorted(r["_format"] for r in others.collect())
    if unknown:
        raise ValueError(f"Unsupported format: {', '.join(unknown)}; supported: {', '.join(P.FORMATS)}")
    file = F.concat("_stem", F.lit("_"), F.substring("_content_md5", 1, 8), F.lit("."), "_format")
    keyed = facts.withColumn("_source_file", object_key("bronze", table, file, _wall_clock(moment), F.lit(source)))
    files = keyed.groupBy("_source_file", "_content_md5", "_format").agg(F.min("_path").alias("_path"))
    fresh = materialize(not_landed(files, _landed(spark, root, table, source, moment)))
    _land_files(spark, fresh, root, table, source, moment, schema_version)
    return _result(spark, files, root, table, source, moment, schema_version)


def _land_files(spark, fresh: DataFrame, root, table, source, moment, schema_version) -> None:
    by_format: dict[str, list[str]] = {}
    # the paths go back into readers, whose file listing lives on the driver anyway
    for row in fresh.select("_path", "_format").toLocalIterator():
        by_format.setdefault(row["_format"], []).append(row["_path"])
    frames = []
    if "jsonl" in by_format:
        frames.append(_jsonl_records(spark, [_decoded(p) for p in by_format["jsonl"]]))
    if "json" in by_format:
        frames.append(_json_records(spark, [_decoded(p) for p in by_format["json"]]))
    if "csv" in by_format:
        frames.extend(_csv_records(spark, [_decoded(p) for p in by_format["csv"]]))
    for frame in frames:
        records = lookup_join(frame, fresh, ["_path"], "inner").select(
            "payload", "_source_file", "_content_md5", F.substring("_content_md5", 1, 8).alias("_file_hash"),
            "_block_pos", "_row_pos", F.col("_format").alias("_original_format"),
            F.lit(schema_version).alias("_schema_version"), F.lit(moment).alias("_ingestion_timestamp"),
            F.lit(source).alias("source"), *[v.alias(k) for k, v in partition_values(_wall_clock(moment)).items()])
        _append(records, root, table)


def ingest_file(spark: SparkSession, root: str, table: str, source: str, path: str,
                schema_version: str = "1.0", at: datetime | None = None) -> dict:
    """Land one file, its path taken literally; its result as a dictionary."""
    return ingest_files(spark, root, table, source, _literal(path), schema_version, at).first().asDict()


def payload_records(payloads: DataFrame, file_format: str) -> DataFrame:
    """Explode a ``payload`` column of whole file contents into records with ``_row_pos``."""
    if file_format not in P.FORMATS:
        raise ValueError(f"Unsupported format: {file_format}; supported: {', '.join(P.FORMATS)}")
    content = F.col("payload").cast("string")
    split = P.csv_records(content) if file_format == "csv" else P.records(content, F.lit(file_format))
    others = [c for c in payloads.columns if c != "payload"]
    return payloads.select(*map(named, others), F.posexplode(split).alias("_row_pos", "payload")).withColumn(
        "_row_pos", F.col("_row_pos").cast("long"))


def ingest_payloads(
    payloads: DataFrame,
    root: str,
    table: str,
    source: str,
    file_format: str,
    schema_version: str = "1.0",
    at: datetime | None = None,
) -> DataFrame:
    """Land contents held in a ``payload`` column, one file each, named by ``filename`` if given.

    Without a name the landing second is part of the key, so that repeats are kept.
    """
    spark = payloads.sparkSession
    moment = _moment(at)
    content = F.col("payload").cast("binary")
    digest = F.md5(content)
    stem = F.lit(f"{table}_{moment:%Y%m%d%H%M%S}")
    if "filename" in payloads.columns:
        stem = F.coalesce(_stem(F.col("filename")), stem)
    file = F.concat(stem, F.lit("_"), F.substring(digest, 1, 8), F.lit(f".{file_format}"))
    keyed = payloads.select(
        "payload", digest.alias("_content_md5"), F.lit(file_format).alias("_format"),
        object_key("bronze", table, file, _wall_clock(moment), F.lit(source)).alias("_source_file"))
    # equal key and MD5 mean equal content: one copy per key, picked before the shuffle
    files = keyed.groupBy("_source_file", "_content_md5", "_format").agg(F.max("payload").alias("payload"))
    fresh = not_landed(files, _landed(spark, root, table, source, moment))
    records = payload_records(fresh, file_format).select(
        "payload", "_source_file", "_content_md5", F.substring("_content_md5", 1, 8).alias("_file_hash"),
        F.lit(0).cast("long").alias("_block_pos"), "_row_pos", F.col("_format").alias("_original_format"),
        F.lit(schema_version).alias("_schema_version"), F.lit(moment).alias("_ingestion_timestamp"),
        F.lit(source).alias("source"), *[v.alias(k) for k, v in partition_values(_wall_clock(moment)).items()])
    _append(records, root, table)
    return _result(spark, files.drop("payload"), root, table, source, moment, schema_version)


def list_ingested(
    spark: SparkSession,
    root: str,
    table: str,
    source: str | None = None,
    start: date | datetime | None = None,
    end: date | datetime | None = None,
) -> DataFrame:
    """Stored objects of a bronze table: key, size, modified, and their partition.

    Only file metadata is read: the content column is pruned.
    """
    folders = _folders(spark, root, table, start, end, source)
    if not folders:
        return spark.createDataFrame([], "key string, size bigint, modified timestamp, source string, year int, month int, day int")
    listed = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="*.parquet").load(
        [_literal(f) for f in folders])
    key = F.concat(F.lit(f"bronze/{table}/"), F.substring_index("path", f"/bronze/{table}/", -1))
    objects = listed.select(key.alias("key"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    parts = parse_key(F.col("key"))
    parts["source"] = F.url_decode(F.replace(parts["source"], F.lit("+"), F.lit("%2B")))
    return objects.withColumns({p: parts[p] for p in PARTITIONS}).where(partition_filter(start, end, source))


def ingested_files(spark: SparkSession, root: str, table: str, **where) -> DataFrame:
    """The original files behind a bronze table with their tags and record counts."""
    tags = ("_source_file", "_file_hash", "_original_format", "_schema_version", "_ingestion_timestamp")
    return read_bronze(spark, root, table, **where).groupBy(*tags).agg(F.count(F.lit(1)).alias("record_count"))
