"""Finding column types of landed records, on the executors."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierlake.functions.columns import named

# CSV cells that mean "no value".
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
_INTEGER = r"^\s*[+-]?[0-9]+\s*$"
_REAL = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$|^\s*[+-]?([iI]nf|[iI]nfinity)\s*$"
_BOOLEAN = ("True", "TRUE", "true", "False", "FALSE", "false")


def json_schema(records: DataFrame, payload: str = "payload") -> T.StructType:
    """One schema for all JSON records: a single distributed aggregate over their types."""
    merged = records.agg(F.schema_of_variant_agg(F.parse_json(named(payload))).alias("s")).first()["s"]
    if not merged or merged == "VOID":
        return T.StructType()
    slot = r"(^|: |ARRAY<)"
    ddl = re.sub(slot + r"OBJECT<", r"\1STRUCT<", merged)
    ddl = re.sub(slot + r"DECIMAL\(\d+, ?\d+\)", r"\1DOUBLE", ddl)
    ddl = re.sub(slot + r"(VARIANT|VOID)(?=[,>]|$)", r"\1STRING", ddl)
    if not ddl.startswith("STRUCT<"):
        raise ValueError(f"records are not all JSON objects: {merged}")
    return T._parse_datatype_string(ddl)


def blank_tokens(df: DataFrame, tokens: tuple[str, ...] = NA_TOKENS) -> DataFrame:
    """Turn the tokens that mean "no value" into null in every string column."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~named(c).isin(*tokens), named(c)) for c in texts})


def _all(df_column: Column, holds: Column) -> Column:
    return F.coalesce(F.bool_and(df_column.isNull() | holds), F.lit(True))


def text_types(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """Type of each text column (bigint, double, boolean or string), from one aggregate.

    A column without any value is double, as an empty numeric column would be.
    """
    tests = []
    for i, name in enumerate(columns):
        c = named(name)
        tests += [
            _all(c, c.rlike(_INTEGER) & F.trim(c).try_cast("bigint").isNotNull()).alias(f"i{i}"),
            _all(c, c.rlike(_REAL)).alias(f"r{i}"),
            _all(c, c.isin(*_BOOLEAN)).alias(f"b{i}"),
            F.count(c).alias(f"n{i}"),
        ]
    if not tests:
        return {}
    seen = df.agg(*tests).first()
    types = {}
    for i, name in enumerate(columns):
        if seen[f"n{i}"] == 0:
            types[name] = "double"
        elif seen[f"i{i}"]:
            types[name] = "bigint"
        elif seen[f"r{i}"]:
            types[name] = "double"
        else:
            types[name] = "boolean" if seen[f"b{i}"] else "string"
    return types


def cast_text(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.withColumns({
        c: (F.trim(named(c)) if t in ("bigint", "double") else named(c)).cast(t) for c, t in types.items()
    }) if types else df
