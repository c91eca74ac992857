"""Helpers shared by the test modules."""

SF_SMALL = "/root/testdata/sf0.001"


def rows(df, *cols):
    """Collect as a list of tuples (ordered by the given columns, or all columns)."""
    cols = cols or tuple(df.columns)
    return [tuple(r) for r in df.select(*cols).orderBy(*cols).collect()]


def literal_raw(spark, table, rows, scrub=True):
    """A raw export from literal rows: text columns in the table's raw order plus ``_seq``,
    nulls scrubbed like a CSV scan."""
    from arcash.schemas import RAW_COLUMNS
    from arcash.sources.raw import SEQ, scrub_nulls
    cols = list(RAW_COLUMNS[table])
    data = [tuple(None if v is None else str(v) for v in r) + (i,) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in cols) + f", {SEQ} bigint")
    return scrub_nulls(df) if scrub else df
