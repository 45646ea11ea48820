"""Table readers (S1, S2) and small-result hand-off."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def load_table(
    spark: SparkSession,
    path: str,
    format: str = "csv",
    schema: T.StructType | str | None = None,
    header: bool = True,
    infer_schema: bool = True,
    **options,
) -> DataFrame:
    """Read a table with any Spark data source; CSV with a header by default.

    The path is used exactly as given.  An explicit ``schema`` skips the
    inference pass (a full extra scan for CSV), which is what large inputs
    should use.
    """
    reader = spark.read.format(format)
    if format == "csv":
        reader = reader.option("header", str(header).lower())
        if schema is None:
            reader = reader.option("inferSchema", str(infer_schema).lower())
    if schema is not None:
        reader = reader.schema(schema)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def get_table(spark: SparkSession, path: str, verbose: bool = False, **kwargs) -> DataFrame:
    """``load_table`` plus an optional schema print."""
    df = load_table(spark, path, **kwargs)
    if verbose:
        df.printSchema()
    return df


def read_parquet_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """One table of a directory of ``<name>.parquet`` files (``load_table`` with the parquet source)."""
    return load_table(spark, f"{base_dir.rstrip('/')}/{name}.parquet", format="parquet")


def to_pandas_small(df: DataFrame, max_rows: int = 100_000):
    """Hand a small result to the driver, refusing anything larger than ``max_rows``.

    Results of this package (profiles, metrics, histories) are bounded by the
    number of columns, bins, classes or epochs, never by the data size.
    """
    head = df.limit(max_rows + 1).toPandas()
    if len(head) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; keep it distributed or write it out")
    return head
