"""From landed records to typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions.columns import named
from tierlake.functions.typing import blank_tokens, cast_text, json_schema, text_types
from tierlake.sources.landing import FILE_ORDER


def _expanded(records: DataFrame, schema: T.StructType) -> DataFrame:
    if not schema.fields:  # records without any member
        return records.select(*FILE_ORDER)
    # read as an array of one: text after the first value is then an error, not ignored
    wrapped = F.concat(F.lit("["), "payload", F.lit("]"))
    values = F.from_json(wrapped, T.ArrayType(schema), {"mode": "FAILFAST"})
    several = F.raise_error(F.concat(F.lit("not one JSON value: "), F.substring("payload", 1, 200)))
    one = F.when(F.size("_values") == 1, F.get("_values", 0)).otherwise(several)
    parsed = records.select(*FILE_ORDER, "payload", values.alias("_values"))
    return parsed.select(*FILE_ORDER, one.alias("_record")).select("_record.*", *FILE_ORDER)


def _from_json(records: DataFrame) -> DataFrame:
    return _expanded(records, json_schema(records))


def _from_csv(records: DataFrame) -> DataFrame:
    """CSV cells were landed as text: blank out the "no value" tokens, then find the types."""
    names = [f.name for f in json_schema(records).fields]
    texts = T.StructType([T.StructField(n, T.StringType()) for n in names])
    cells = blank_tokens(_expanded(records, texts).select(*map(named, names), *FILE_ORDER))
    return cast_text(cells, text_types(cells, names))


def union_records(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; absent columns are null, clashing types meet in double or string."""
    wanted: dict[str, T.DataType] = {}
    for frame in frames:
        for field in frame.schema.fields:
            known = wanted.setdefault(field.name, field.dataType)
            if known != field.dataType:
                numeric = isinstance(known, T.NumericType) and isinstance(field.dataType, T.NumericType)
                wanted[field.name] = T.DoubleType() if numeric else T.StringType()
    aligned = []
    for frame in frames:
        changed = {f.name: wanted[f.name] for f in frame.schema.fields if f.dataType != wanted[f.name]}
        aligned.append(frame.withColumns({
            c: (F.to_json(named(c)) if isinstance(frame.schema[c].dataType, (T.StructType, T.ArrayType, T.MapType))
                else named(c)).cast(t)
            for c, t in changed.items()
        }) if changed else frame)
    result = aligned[0]
    for frame in aligned[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def parse_records(records: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Typed columns of bronze records plus ``_source_file``, ``_block_pos`` and ``_row_pos``.

    With a schema nothing is inferred; otherwise types are found over all files of a kind.
    """
    if schema is not None:
        return _expanded(records, schema)
    kinds = {r["_original_format"] for r in records.select("_original_format").distinct().collect()}
    unknown = kinds - {"json", "jsonl", "csv"}
    if unknown:
        raise ValueError(f"Unknown file type: {', '.join(sorted(unknown))}")
    frames = []
    if kinds & {"json", "jsonl"}:
        frames.append(_from_json(records.where(F.col("_original_format") != "csv")))
    if "csv" in kinds:
        frames.append(_from_csv(records.where(F.col("_original_format") == "csv")))
    if not frames:
        return records.select(*FILE_ORDER)
    ordered = union_records(frames)
    data = [c for c in ordered.columns if c not in FILE_ORDER]
    return ordered.select(*map(named, data), *FILE_ORDER)
