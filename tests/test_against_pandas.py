"""Random small frames: the operators against pandas."""

import math
import random

import pandas as pd
import pytest

from tierlake.operators.cleaning import fill_nulls, keep_last
from tierlake.operators.fact import aggregate, lookup_key
from tierlake.operators.quality import QualityChecker

SCHEMA = "pos long, k string, g long, v double, n long"


def frame(seed):
    rng = random.Random(seed)
    rows = [
        (i, rng.choice(["a", "b", "c", "hot", "hot", "hot", None]), rng.choice([1, 2, None]),
         rng.choice([None, float("nan"), -1.5, 0.0, 2.25, 7.0]), rng.choice([None, 1, 2, 3, 40]))
        for i in range(rng.choice([1, 7, 60]))]
    rng.shuffle(rows)
    data = pd.DataFrame(rows, columns=["pos", "k", "g", "v", "n"]).astype({"k": object, "g": "Int64", "n": "Int64"})
    data["v"] = data["v"].astype(float)
    return rows, data


def plain(value):
    if value is None or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return None
    return round(float(value), 9) if not isinstance(value, str) else value


@pytest.mark.parametrize("seed", range(4))
def test_operators_agree(spark, seed):
    rows, data = frame(seed)
    df = spark.createDataFrame(rows, SCHEMA)

    last = data.sort_values("pos").drop_duplicates(["k", "g"], keep="last")
    ours = keep_last(df, ["k", "g"], ["pos"])
    assert sorted(r["pos"] for r in ours.collect()) == sorted(last["pos"])

    kept = data.dropna(subset=["k", "g"])
    hows = {"v": ["sum", "mean", "min", "max", "count", "nunique", "median", "std", "var"], "n": ["sum", "median", "max"]}
    for measure, names in hows.items():
        for how in names:
            wanted = {
                (k, int(g)): plain(x) for (k, g), x in
                kept.assign(**{measure: kept[measure].astype(float)}).groupby(["k", "g"])[measure].agg(how).items()}
            got = {(r["k"], r["g"]): plain(r[measure]) for r in aggregate(df, ["k", "g"], {measure: how}).collect()}
            assert got == wanted, (measure, how)

    dim = spark.createDataFrame([(1, "a"), (2, "hot"), (3, "a"), (4, None)], "sk long, k string")
    lookup = {"a": 3, "hot": 2}
    found = {r["pos"]: r["fk"] for r in lookup_key(df, dim, "k", "fk").collect()}
    assert found == {r[0]: lookup.get(r[1]) for r in rows}

    report = (QualityChecker().check_null_rate("v", 0.2).check_uniqueness(["k", "v"], 0.5).check_value_range("v", -1, 5)
              .run(df, "t", "silver"))
    rate = data["v"].isna().mean()
    distinct = len(data[["k", "v"]].drop_duplicates()) / len(data)
    low, high = data["v"].min(), data["v"].max()
    assert [r.passed for r in report.results] == [rate <= 0.2, distinct >= 0.5, not (low < -1 or high > 5)]
    assert [report.results[0].value, report.results[1].value] == [round(rate, 4), round(distinct, 4)]

    filled = {r["pos"]: r for r in fill_nulls(df).collect()}
    for pos, k, g, v, n in rows:
        row = filled[pos]
        assert (row["k"], row["g"], row["n"]) == (k or "", g or 0, n or 0)
        assert row["v"] == (0.0 if v is None or math.isnan(v) else v)
