import pyarrow.dataset as ds


def table(folder, name):
    return ds.dataset(f"{folder}/{name}.parquet").to_table().to_pandas()


def rows(df, *names):
    """Rows of a Spark table as sorted tuples."""
    return sorted((tuple(r) for r in (df.select(*names) if names else df).collect()), key=repr)
