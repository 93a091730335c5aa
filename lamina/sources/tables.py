"""Table access and the stand-in inputs built from the driver's tables.

The reference reads a pupil fact, a region dimension and an area dimension.
Here the same shapes are derived, by Spark, from the TPC-H-like tables
(orders, customer, nation, region), with nulls injected by fixed rules so the
null-handling paths run. The exact rules are mirrored in ``plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.plans.joins import sized_broadcast

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

FACT_COLUMNS = ("entity_id", "group_id", "period", "region_code", "area_code",
                "segment_code", "measure", "outcome", "present")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def input_files(spark: SparkSession, sf_dir: str) -> tuple:
    """The files behind the relational stand-ins, with their lengths and times: what a
    session keeps of an input holds only while they stay the same."""
    out = []
    for name in ("region", "nation", "customer", "orders", "lineitem"):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, name))
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        out += [(s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(path)]
    return tuple(sorted(out))


def _null_when_multiple(c: str, modulus: int, key: str = "o_orderkey"):
    return F.when(F.col(key) % modulus == 0, F.lit(None)).otherwise(F.col(c))


def fact_waves(spark: SparkSession, sf_dir: str, split_year: int = 1998) -> list[DataFrame]:
    """The fact in two yearly deliveries; each scan skips by the stored date."""
    orders = read_table(spark, sf_dir, "orders")
    split = F.make_date(F.lit(split_year), F.lit(1), F.lit(1)).cast(orders.schema["o_orderdate"].dataType)
    return [fact_frame(spark, sf_dir, F.col("o_orderdate") < split),
            fact_frame(spark, sf_dir, F.col("o_orderdate") >= split)]


def fact_frame(spark: SparkSession, sf_dir: str, wave=None) -> DataFrame:
    """Entity fact: one row per order, codes shifted by +1 so 0 means missing; of the
    orders that ``wave`` picks."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority")
    if wave is not None:
        orders = orders.filter(wave)
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    # customer grows with the data: a shuffle join unless it is proven small
    joined = (orders
              .join(sized_broadcast(customer), F.col("o_custkey") == F.col("c_custkey"), "left")
              .join(sized_broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"), "left"))
    k = F.col("o_orderkey")
    return joined.select(
        k.alias("entity_id"),
        F.when(F.col("o_custkey") % 50 == 0, F.lit(None)).otherwise(F.col("o_custkey"))
        .alias("group_id"),
        F.year("o_orderdate").cast("int").alias("period"),
        F.when(k % 97 == 0, F.lit(None)).otherwise(F.col("n_regionkey") + 1).alias("region_code"),
        F.when(k % 89 == 0, F.lit(None)).otherwise(F.col("c_nationkey") + 1).alias("area_code"),
        F.when(k % 83 == 0, F.lit(None))
        .otherwise(F.substring("o_orderpriority", 1, 1).cast("int")).alias("segment_code"),
        _null_when_multiple("o_totalprice", 79).alias("measure"),
        F.when(F.col("o_orderstatus") == "F", F.lit(1))
        .when(F.col("o_orderstatus") == "O", F.lit(0)).alias("outcome"),
        F.when(k % 73 == 0, F.lit(None)).when(k % 10 == 0, F.lit(0)).otherwise(F.lit(1))
        .alias("present"),
    )


def region_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "region").select(
        (F.col("r_regionkey") + 1).alias("region_code"), F.col("r_name").alias("region_name"))


def area_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area dimension with one empty name (exercises the empty-text default)."""
    return read_table(spark, sf_dir, "nation").select(
        (F.col("n_nationkey") + 1).alias("area_code"),
        F.when(F.col("n_nationkey") == 7, F.lit("")).otherwise(F.col("n_name"))
        .alias("area_name"))


def period_slices(spark: SparkSession, sf_dir: str, split_year: int = 1998) -> list[DataFrame]:
    """Two yearly waves of a source table: orders before / from ``split_year``.

    The later wave lacks ``o_orderpriority`` (a source whose schema changed
    between waves), so stacking must null-fill it. Together the waves hold
    every order exactly once.
    """
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_orderdate")
    # a range of the stored date, not of its year: the scan can skip by it
    split = F.make_date(F.lit(split_year), F.lit(1), F.lit(1)).cast(orders.schema["o_orderdate"].dataType)
    year = F.year("o_orderdate").cast("int").alias("o_year")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    early = orders.filter(F.col("o_orderdate") < split).select(*columns, "o_orderpriority", year)
    late = orders.filter(F.col("o_orderdate") >= split).select(*columns, year)
    return [early, late]
