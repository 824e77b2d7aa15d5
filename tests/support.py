"""What several test modules use."""


def values(df, *columns):
    """Rows as sorted tuples."""
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in rows), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
