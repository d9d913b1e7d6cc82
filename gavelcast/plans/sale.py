"""The ``sale`` view: an auction-like sales table derived from the order tables.

Adds missing values, placeholder years, a rare level, bad dates and minable text
to ``lineitem`` joined with its dimensions. Catalyst prunes what a query does not
select; join strategies follow table sizes, and AQE splits skewed keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..params import Settings
from ..runtime import spread

SALE_SETTINGS = Settings(
    target="sale_price",
    log_target="log_sale_price",
    group="product_group",
    year="year_made",
    hours="hours",
    class_text="class_desc",
    sale_date="sale_date",
    dropped=("l_orderkey", "l_linenumber", "l_partkey", "sale_date", "c_name", "n_name"),
    group_imputed=("hours", "Horsepower", "Weight_Tons", "year_made"),
    target_encoded=("model_desc", "class_desc"),
    one_hot=("usage_band", "p_type", "c_mktsegment", "product_group"),
    split_key="l_orderkey",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sale(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, part, orders, customer, nation = (
        table(spark, sf_dir, n) for n in ("lineitem", "part", "orders", "customer", "nation"))
    # Orders meet their customers first: lines, four an order, are then shuffled once for them, before part widens them.
    bought = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    joined = (
        spread(lineitem).join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
    )
    size = F.col("p_size")
    year = (
        F.when(size % 7 == 0, 1000).when(size == 13, 1940)
        .when(size % 11 == 0, F.lit(None).cast("int")).otherwise(1950 + size))
    band = (
        F.when(F.col("l_orderkey") == 7, "RARE-A")
        .when(F.col("l_orderkey") % 17 != 0, F.col("o_orderpriority")))
    text = size.cast("string")
    described = (
        F.when(F.col("l_partkey") % 2 == 0, F.concat(
            F.lit("Loader - "), text, F.lit(".5 to "), (size + 5).cast("string"),
            F.lit(".0 Horsepower")))
        .when(F.col("l_partkey") % 3 == 0, F.concat(
            F.lit("Dozer - "), text, F.lit(" to "), (size + 2).cast("string"),
            F.lit(" Metric Tons")))
        .otherwise("Unidentified"))
    date = F.when(F.col("l_orderkey") % 50 == 0, "bad date").otherwise(
        F.col("o_orderdate").cast("string"))
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_extendedprice",
        "o_totalprice", "c_mktsegment", "c_name", "n_name", F.col("p_name").alias("model_desc"),
        "p_type",
        (F.col("l_quantity") * F.col("p_retailprice") * (1 - F.col("l_discount"))).alias("sale_price"),
        year.alias("year_made"),
        F.when(F.col("l_linenumber") % 3 != 0, F.col("l_quantity") * 100).alias("hours"),
        F.when(F.col("l_partkey") % 13 != 0, F.col("p_brand")).alias("product_group"),
        band.alias("usage_band"), described.alias("class_desc"), date.alias("sale_date"),
    )
