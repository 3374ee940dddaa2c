"""Files in and out: typed CSV, Parquet layers, staged tables, fingerprints."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfcast.operators.sales import SERIES_COLUMNS

PRICES_SCHEMA = "store_id string, item_id string, wm_yr_wk int, sell_price double"

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`.

    Only a local session may go without it; then a temporary folder of this machine is used.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="shelfcast-")
        atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
    return _local_dirs[app]


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table used more than once to the shared folder and read it back.

    Cuts the lineage with files that outlive executors, computes the input once, and gives Spark the
    true size of small sides, so that it broadcasts them only below its own threshold.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/shelfcast/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged_all(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Stage independent tables at the same time; each alone would leave executors idle at its end."""
    with ThreadPoolExecutor(max_workers=max(1, len(tables))) as pool:
        running = {
            name: pool.submit(inheritable_thread_target(df.sparkSession)(staged), df, name)
            for name, df in tables.items()
        }
        return {name: job.result() for name, job in running.items()}


def read_csv(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """Typed CSV scan. Without a schema the types are inferred from every row, not from a sample."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).option("samplingRatio", 1.0).csv(path)
    return reader.schema(schema).csv(path)


def wide_sales_schema(n_days: int, id_columns=SERIES_COLUMNS) -> str:
    """Schema of the wide sales file, which spares the inference scan."""
    return ", ".join([f"{c} string" for c in id_columns] + [f"d_{i} smallint" for i in range(1, n_days + 1)])


def csv_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str, schema=None) -> DataFrame:
    df = read_csv(spark, csv_path, schema)
    df.write.mode("overwrite").option("compression", "zstd").parquet(parquet_path)
    return spark.read.parquet(parquet_path)


def write_layer(df: DataFrame, path: str, partition_by=()) -> None:
    """Replace a table. Rows are clustered by the partition columns first, so that each partition is
    written by few tasks; Spark splits a large partition, and joins small ones, by their size when it runs."""
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def table_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_cols")
        )
        for name, df in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def fingerprint(tables: dict[str, DataFrame]) -> DataFrame:
    """Version of the content of each table, whatever the order of rows and files."""
    parts = []
    for name, df in tables.items():
        row_hash = F.xxhash64(*sorted(df.columns))
        parts.append(
            df.select(row_hash.alias("h"))
            .agg(
                F.count(F.lit(1)).alias("n_rows"),
                F.coalesce(F.sum(F.col("h").cast("decimal(20,0)")), F.lit(0)).cast("string").alias("hash_sum"),
                F.bit_xor("h").alias("hash_xor"),
            )
            .select(F.lit(name).alias("table_name"), "n_rows", "hash_sum", "hash_xor")
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.withColumn(
        "version", F.substring(F.sha2(F.concat_ws("|", "n_rows", "hash_sum", "hash_xor"), 256), 1, 12)
    )
