"""Result formats: bounded ones on the driver, files written by the executors."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame


MOST_ROWS = 1_000_000


def _bounded(df: DataFrame, limit: int) -> DataFrame:
    return df.limit(limit if limit > 0 else MOST_ROWS + 1)


def _whole(found: int, limit: int) -> None:
    """Without a limit a result comes whole or not at all: nothing is cut off unasked."""
    if limit <= 0 and found > MOST_ROWS:
        raise ValueError(f"more than {MOST_ROWS} rows: ask for a limit, or write files on the executors")


def rows(df: DataFrame, limit: int = 0) -> list[dict]:
    """Row dictionaries; ``limit=0`` asks for all of them, a million at most."""
    found = _bounded(df, limit).collect()
    _whole(len(found), limit)
    return [row.asDict(recursive=True) for row in found]


def to_pandas(df: DataFrame, limit: int = 0) -> pd.DataFrame:
    found = _bounded(df, limit).toPandas()
    _whole(len(found), limit)
    return found


def to_arrow(df: DataFrame, limit: int = 0) -> pa.Table:
    found = _bounded(df, limit).toArrow()
    _whole(found.num_rows, limit)
    return found


def json_text(df: DataFrame, limit: int = 0) -> str:
    """JSON array of the rows."""
    found = _bounded(df, limit).toJSON().collect()
    _whole(len(found), limit)
    return "[" + ",\n ".join(found) + "]"


def csv_text(df: DataFrame, limit: int = 0) -> str:
    """CSV with header, cells quoted where needed; bounded like the other texts, see ``write_csv``."""
    return to_pandas(df, limit).to_csv(index=False)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).option("escape", '"').csv(path)
