"""Small helpers shared by the tests."""


def rows(df, *columns):
    """Sorted row tuples; None sorts first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, str(type(v)), v) for v in t])


def same_rows(a, b):
    return sorted(a.columns) == sorted(b.columns) and rows(a.select(sorted(a.columns))) == rows(
        b.select(sorted(b.columns))
    )


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()
