"""Bronze to silver to gold: the flagship flow over order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkloom.session import table


def silver_dedup_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-way join, gate, label theme, keyed dedup, then one gold row per theme and segment.

    The dimension sides are left to Catalyst: it broadcasts them only while their
    size statistics stay below the session's threshold and sort-merges otherwise.
    """
    lines = table(spark, sf_dir, "lineitem").where("l_quantity >= 5 AND l_returnflag <> 'R'")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    label = F.lower(F.trim(F.regexp_replace("o_orderpriority", r"^[0-9]-", "")))
    themed = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .withColumn("label", label)
        .withColumn(
            "theme",
            F.when(F.col("label").rlike("urgent|high"), "rush").when(F.col("label").rlike("low"), "slow").otherwise("normal"),
        )
    )
    newest = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(
        F.desc("l_extendedprice"), F.desc("l_shipdate"), F.asc("l_partkey"), F.asc("l_suppkey")
    )
    silver = themed.withColumn("rank_in_key", F.row_number().over(newest)).where("rank_in_key = 1")
    money = F.col("l_extendedprice").cast("decimal(18,2)")
    return silver.groupBy("theme", F.col("c_mktsegment").alias("segment")).agg(
        F.count("*").alias("n_lines"),
        F.countDistinct("l_orderkey").alias("n_orders"),
        F.sum(money).cast("double").alias("revenue"),
        F.round(F.lit(100.0) * F.count_if(F.col("l_returnflag") == "N") / F.count("*"), 1).alias("open_pct"),
    )


SILVER_SQL = """
WITH themed AS (
  SELECT l.*, c_mktsegment,
         CASE WHEN regexp_matches(lower(trim(regexp_replace(o_orderpriority, '^[0-9]-', ''))), 'urgent|high') THEN 'rush'
              WHEN regexp_matches(lower(trim(regexp_replace(o_orderpriority, '^[0-9]-', ''))), 'low') THEN 'slow'
              ELSE 'normal' END AS theme
  FROM lineitem l JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  WHERE l_quantity >= 5 AND l_returnflag <> 'R'),
silver AS (
  SELECT * FROM themed QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_extendedprice DESC, l_shipdate DESC, l_partkey, l_suppkey) = 1)
SELECT theme, c_mktsegment AS segment, count(*) AS n_lines, count(DISTINCT l_orderkey) AS n_orders,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       round(100.0 * count(*) FILTER (l_returnflag = 'N') / count(*), 1) AS open_pct
FROM silver GROUP BY theme, c_mktsegment
"""

QUERIES = {"silver_dedup_gold": (silver_dedup_gold, SILVER_SQL)}
