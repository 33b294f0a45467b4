"""The engine's inputs as views of the standard tables. Names are shared on purpose, so that all outcomes occur."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import table


def registry(spark: SparkSession, sf: str) -> DataFrame:
    """One row for each customer and supplier with a common order: persons share names, some organisations too."""
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    pairs = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(F.col("o_custkey").alias("id_per"), F.col("l_suppkey").alias("id_org")).distinct()
    return pairs.select(
        "id_per",
        F.concat(F.lit("Mari"), F.col("id_per") % 97).alias("first_name"),
        F.concat(F.lit("Tamm"), F.col("id_per") % 13).alias("last_name"),
        "id_org",
        F.concat(F.lit("Firma "), F.col("id_org") % 71, F.when(F.col("id_org") % 3 == 0, " Osaühing").otherwise(" AS")).alias("name_org"),
        F.md5(F.concat_ws(",", "id_per", "id_org")).alias("row_hash"),
    )


def names(spark: SparkSession, sf: str) -> DataFrame:
    """page, label, entity: an order names its customer, the suppliers of its lines, and its parts."""
    orders, lines, parts = table(spark, sf, "orders"), table(spark, sf, "lineitem"), table(spark, sf, "part")
    people = orders.select(F.col("o_orderkey").alias("page"), F.lit("PER").alias("label"), F.concat(F.lit("Mari"), F.col("o_custkey") % 97, F.lit(" Tamm"), F.col("o_custkey") % 13, F.when(F.col("o_custkey") % 5 == 0, F.lit("|Tammo")).otherwise("")).alias("entity"))
    firms = lines.select(F.col("l_orderkey").alias("page"), F.lit("ORG").alias("label"), F.concat(F.when(F.col("l_suppkey") % 3 == 0, "OÜ ").otherwise(""), F.lit("Firma "), F.col("l_suppkey") % 71, F.when(F.col("l_suppkey") % 3 == 0, "").otherwise(" AS")).alias("entity"))
    things = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("page"), F.lit("LOC").alias("label"), F.col("p_name").alias("entity"))
    return people.union(firms).union(things)


def exclusions(spark: SparkSession, sf: str) -> DataFrame:
    """name, tag1, synonym: a part name in four excludes, one in four is a synonym of a firm."""
    parts = table(spark, sf, "part").select("p_name").distinct()
    n = F.length("p_name") % 4
    return parts.select(F.col("p_name").alias("name"), F.when(n == 0, "loc").when(n == 1, "synonym").otherwise("multi").alias("tag1"), F.when(n == 1, "Firma 7 AS").otherwise("").alias("synonym"))
