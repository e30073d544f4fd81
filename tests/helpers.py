"""What tests share; fixtures are in conftest."""

SF = "/root/testdata/sf0.001"


def rows(df):
    """Collected rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
