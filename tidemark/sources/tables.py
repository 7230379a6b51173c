"""One loader seam for warehouse tables.

Everything downstream takes DataFrames, so swapping Parquet for a catalog table is a
one-line change here. Reads are lazy: Catalyst prunes the columns and pushes the
filters each query actually uses down to the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table: a Parquet file/folder under ``sf_dir`` or a catalog table."""
    if sf_dir:
        return spark.read.parquet("%s/%s.parquet" % (sf_dir.rstrip("/"), name))
    return spark.table(name)


class Tables:
    """Lazy accessor: ``t.orders`` reads ``orders`` once per accessor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name in ("spark", "sf_dir"):
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]
