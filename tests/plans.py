"""Reading physical plans in tests."""


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """Plan after adaptive execution."""
    df.collect()
    return plan_text(df)
