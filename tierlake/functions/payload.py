"""Raw file content as a column: hash, record count, splitting into records."""

from __future__ import annotations

import csv
import io
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The file formats accepted at landing.
FORMATS = ("json", "csv", "jsonl")


def short_hash(content: Column) -> Column:
    """First 8 hex digits of the MD5 of the whole content."""
    return F.substring(F.md5(content), 1, 8)


def is_one_document(content: Column) -> Column:
    """Whether the text is exactly one JSON value; Spark's parsers ignore what follows the first.

    Inside brackets a second value is either a syntax error or a second element.
    """
    return F.coalesce(F.json_array_length(F.concat(F.lit("["), content, F.lit("]"))) == 1, F.lit(False))


def lines(content: Column) -> Column:
    """Non-blank lines."""
    return F.filter(F.split(content, "\n"), lambda line: F.trim(F.translate(line, "\r\t", "  ")) != "")


#: A quoted cell, from the start of a line or behind a comma up to the next comma or line end.
_QUOTED_CELL = r'(^|[,\n\r])"(?:[^"]++|"")*+"(?=[,\n\r]|$)'


def without_quoted_cells(text: Column) -> Column:
    """CSV text with each well-formed quoted cell replaced by one letter; quotes inside other cells stay."""
    return F.regexp_replace(text, _QUOTED_CELL, "$1q")


def needs_whole_file(line: Column) -> Column:
    """Whether a CSV line begins a quoted cell that it doesn't end, or one that goes on behind its quote."""
    return without_quoted_cells(line).rlike('(^|,)"')


def record_count(content: Column, file_format: Column) -> Column:
    """Records in the content: array length or 1, non-blank lines, CSV rows without header.

    Line breaks inside quoted CSV cells do not count; a quote inside another cell is no quote.
    """
    is_array = F.ltrim(F.translate(content, "\n\r\t", "   ")).startswith("[")
    in_json = F.when(is_array, F.json_array_length(content)).otherwise(1)
    rows = lines(F.regexp_replace(without_quoted_cells(content), r"\r\n?", "\n"))
    in_csv = F.greatest(F.size(rows) - 1, F.lit(0))
    return (
        F.when(file_format == "json", in_json)
        .when(file_format == "jsonl", F.size(lines(content)))
        .when(file_format == "csv", in_csv)
        .otherwise(0)
    ).cast("long")


def unique_names(header: list[str]) -> list[str]:
    """Column names of a CSV header; nameless ones get their position, repeated ones a number."""
    seen: dict[str, int] = {}
    names = []
    for position, name in enumerate(header):
        name = name or f"Unnamed: {position}"
        count = seen.get(name, 0)
        seen[name] = count + 1
        names.append(f"{name}.{count}" if count else name)
    return names


def _csv_rows(text: str) -> Iterator[list[str]]:
    """Rows of CSV text; blank lines between rows are passed over, rows of empty cells are not."""
    inside = False

    def physical_lines() -> Iterator[str]:
        nonlocal inside
        for line in io.StringIO(text, newline=""):
            if inside or line.strip():
                inside = True
                yield line

    for row in csv.reader(physical_lines()):
        inside = False
        yield row


@F.pandas_udf(T.ArrayType(T.StringType()))
def csv_records(contents: pd.Series) -> pd.Series:
    """Rows of CSV text with a header as JSON objects of strings (empty cells are null)."""

    def split(text: str | None) -> list[str]:
        rows = _csv_rows(text or "")
        header = unique_names(next(rows, []))
        found = []
        for row in rows:
            if len(row) > len(header):
                raise ValueError(f"CSV row longer than its header: {row}")
            row += [""] * (len(header) - len(row))
            found.append(json.dumps({h: cell or None for h, cell in zip(header, row)}, ensure_ascii=False))
        return found

    return contents.map(split)


def records(content: Column, file_format: Column) -> Column:
    """The records of in-memory content, each as JSON text, in order."""
    is_array = F.ltrim(F.translate(content, "\n\r\t", "   ")).startswith("[")
    array = F.from_json(content, "array<string>", {"mode": "FAILFAST"})
    several = F.raise_error(F.concat(F.lit("not one JSON document: "), F.substring(content, 1, 200)))
    return (
        F.when(file_format == "jsonl", lines(content))
        .when((file_format == "json") & ~is_one_document(content), several)
        .when((file_format == "json") & is_array, array)
        .when(file_format == "json", F.array(content))
    )
