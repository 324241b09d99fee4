"""Table sources and sinks.

Reads always take a declared schema for CSV (no inference on large data);
parquet is the default storage, CSV an export.  Writes never pass data
through the driver."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cleansing import na_normalise


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               fmt: str = "csv", drop_index: bool = False, normalise: bool = True) -> DataFrame:
    """A1 + A2: read a headered CSV (or parquet) table.

    ``drop_index`` discards a leading unnamed index column (a file written
    with its row index).  A UTF-8 byte-order mark is skipped by the reader.
    With ``normalise`` NaN and the usual missing tokens become NULL."""
    if fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        r = spark.read.option("header", True).option("mode", "PERMISSIVE")
        if schema is not None:
            if drop_index:
                st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
                schema = T.StructType([T.StructField("_index", T.StringType())] + list(st.fields))
            r = r.schema(schema)
        else:
            r = r.option("inferSchema", True)
        df = r.csv(path)
        if drop_index:
            df = df.drop(df.columns[0])
    return na_normalise(df) if normalise else df


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] | None = None,
                mode: str = "overwrite") -> None:
    """A3: write without an index column; CSV gets a header (and no BOM)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    """Persist prepared rows by split (train / valid / valid_normal / test)."""
    write_table(df, path, "parquet", [split_col])


def write_metrics(df: DataFrame, path: str) -> None:
    """A one-row metric record as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)


def metrics_row(spark: SparkSession, **metrics) -> DataFrame:
    """One-row metrics frame (acc/prec/rec/f1/auc/threshold) for ``write_metrics``."""
    names = list(metrics)
    return spark.createDataFrame([tuple(float(metrics[n]) for n in names)],
                                 ", ".join(f"{n} double" for n in names))


def with_seq(df: DataFrame, name: str = "seq") -> DataFrame:
    """File order as an explicit column, for a frame read straight from files.

    Spark numbers partitions by size, not by name, so a running row id alone
    would put a large later file before a small earlier one.  The order value is
    a struct of file path, block start and the row's id, which ascends within a
    block; it compares in that order."""
    meta = F.col("_metadata")
    return df.withColumn(name, F.struct(meta["file_path"].alias("file"), meta["file_block_start"].alias("block"),
                                        F.monotonically_increasing_id().alias("row")))
