"""The given tables read as forecasts: reference, hindcast, forecast, rain and a source grid.

Forecasts are issued on 1 April and 1 October; every day belongs to the last issue before it, so October issues cross New
Year. Days of 1995-1999 are the calibration period (``obs``, ``mdl``), days since 2000 the forecast (``pred``), ``history``
has all years. All keep one value per key (cell, date, line number), so a cell holds at most 7 values a day
whatever the size of the tables. ``rain`` keeps every event, so its cells grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (
        table(spark, sf_dir, "lineitem")
        .select(
            "l_suppkey",
            "l_linenumber",
            "l_extendedprice",
            "l_quantity",
            "l_discount",
            F.col("l_shipdate").cast("date").alias("valid_date"),
        )
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .withColumn("cell", F.col("s_nationkey").cast("int"))
    )


def shipped_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all years by cell, month and order."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").cast("int").alias("cell"))
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_extendedprice", F.trunc("l_shipdate", "month").alias("month_start"))
    return lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))


def history(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    return (
        (lines or shipped(spark, sf_dir))
        .groupBy("cell", "valid_date")
        .agg(F.max("l_extendedprice").alias("value"))
    )


def obs(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    return history(spark, sf_dir, lines).where(F.year("valid_date").between(1995, 1999))


def _steps(lines: DataFrame) -> DataFrame:
    month = F.month("valid_date")
    year = (F.year("valid_date") - F.when(month < 4, 1).otherwise(0)).alias("issue_year")
    issue_month = F.when(month.between(4, 9), 4).otherwise(10).alias("issue_month")
    issued = lines.select("cell", year, issue_month, "valid_date", "l_linenumber", "l_extendedprice")
    lead = F.datediff("valid_date", F.make_date("issue_year", "issue_month", F.lit(1))).alias("lead")
    return issued.groupBy("cell", "issue_year", "issue_month", lead, F.col("l_linenumber").alias("ens")).agg(
        (F.max("l_extendedprice") * 1.2 + 50).alias("value")
    )


def mdl(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    return _steps((lines or shipped(spark, sf_dir)).where(F.year("valid_date").between(1995, 1999)))


def pred(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    return _steps((lines or shipped(spark, sf_dir)).where(F.year("valid_date") >= 2000))


def rain(spark: SparkSession, sf_dir: str) -> DataFrame:
    past = F.col("event_type").isin("view", "click")
    model = F.col("event_type").isin("purchase", "signup")
    dry_part = F.when(past, 30.0).otherwise(10.0 * (1 + F.col("user_id") % 5))
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % 5).cast("int").alias("cell"),
        F.when(past, "obs").when(model, "mdl").otherwise("pred").alias("role"),
        "event_id",
        (F.dayofmonth("ts") - 1).alias("lead"),
        F.greatest(F.col("value") - dry_part, F.lit(0.0)).alias("value"),
    )


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .groupBy("c_nationkey")
        .agg(F.max("c_acctbal").alias("value"))
        .select(
            F.floor(F.col("c_nationkey") / 5).cast("int").alias("lat_idx"),
            (F.col("c_nationkey") % 5).cast("int").alias("lon_idx"),
            (10.0 + F.floor(F.col("c_nationkey") / 5)).alias("lat"),
            (352.0 + 4 * (F.col("c_nationkey") % 5)).alias("lon"),
            "value",
        )
    )


# The same views in SQL, for the oracles.
_STEPS = """
select cell, issue_year, issue_month, cast(dt - make_date(issue_year, issue_month, 1) as int) as "lead", ens, max(price) * 1.2 + 50 as value
from (select cast(s_nationkey as int) cell, cast(l_shipdate as date) dt, l_linenumber ens, l_extendedprice price,
    cast(year(l_shipdate) - case when month(l_shipdate) < 4 then 1 else 0 end as int) issue_year,
    case when month(l_shipdate) between 4 and 9 then 4 else 10 end issue_month
  from lineitem join supplier on l_suppkey = s_suppkey where year(l_shipdate) {}) group by all"""
VIEW_SQL = {
    "history": """
select cast(s_nationkey as int) cell, cast(l_shipdate as date) valid_date, max(l_extendedprice) value
from lineitem join supplier on l_suppkey = s_suppkey group by 1, 2""",
    "obs": """
select cast(s_nationkey as int) cell, cast(l_shipdate as date) valid_date, max(l_extendedprice) value
from lineitem join supplier on l_suppkey = s_suppkey
where year(l_shipdate) between 1995 and 1999 group by 1, 2""",
    "mdl": _STEPS.format("between 1995 and 1999"),
    "pred": _STEPS.format(">= 2000"),
    "rain": """
select cast(user_id % 5 as int) cell,
  case when event_type in ('view','click') then 'obs'
       when event_type in ('purchase','signup') then 'mdl' else 'pred' end role,
  event_id, cast(dayofmonth(ts) - 1 as int) lead,
  greatest(value - case when event_type in ('view','click') then 30.0e0
                        else 10.0e0 * (1 + user_id % 5) end, 0.0e0) value
from events""",
    "grid": """
select cast(floor(c_nationkey / 5.0e0) as int) lat_idx, cast(c_nationkey % 5 as int) lon_idx,
  10.0e0 + floor(c_nationkey / 5.0e0) lat, 352.0e0 + 4 * (c_nationkey % 5) lon, max(c_acctbal) value
from customer group by c_nationkey""",
}


def with_views(names: list[str], ctes: str, body: str) -> str:
    """WITH clause of the named views, further CTEs and the final select."""
    parts = [f"{n} as materialized ({VIEW_SQL[n]})" for n in names]
    if ctes.strip():
        parts.append(ctes.strip().rstrip(","))
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + body
