"""Stand-in inputs derived from the driver's parquet tables.

These functions only reshape driver rows into the schemas the jobs expect
(readings, weather, requests). They do none of the jobs' work; every job must
be right on any data of that schema. Each mapping has a DuckDB twin in
``SQL`` used by the correctness oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> readings: 5 zones, 35 rides, 30 days of January 2024, 24 hours."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("row_id"),
        F.col("event_type").alias("zona"),
        F.concat(F.col("event_type"), F.lit("_"), (F.col("user_id") % 7).cast("string")).alias("atraccion"),
        F.col("value").alias("tiempo_espera"),
        F.to_date("ts").alias("fecha"),
        F.hour("ts").alias("hora_int"),
        F.date_format("ts", "HH:mm").alias("hora"),
        (F.col("event_id") % 9 != 0).alias("abierta"),
        F.col("ts"),
    )


def readings_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> readings: 1995-2001, all months, dirty hour text, some null weather."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    hora = (F.when(k % 97 == 0, F.lit("n/d"))
            .when(k % 89 == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lpad((F.lit(8) + k % 14).cast("string"), 2, "0"), F.lit(":"),
                                F.lpad(((k % 4) * 15).cast("string"), 2, "0"))))
    return o.select(
        k.alias("row_id"),
        F.col("o_orderpriority").alias("zona"),
        F.concat(F.col("o_orderpriority"), F.lit("_"), (F.col("o_custkey") % 7).cast("string")).alias("atraccion"),
        (F.floor(F.col("o_totalprice") / 25000) * 5).cast("double").alias("tiempo_espera"),
        F.to_date("o_orderdate").alias("fecha"),
        hora.alias("hora"),
        F.when(k % 11 == 0, F.lit(None).cast("double")).otherwise((k % 41).cast("double")).alias("temperatura"),
        (k % 101).cast("double").alias("humedad"),
        (k % 5 + 1).cast("int").alias("codigo_clima"),
        F.when(F.col("o_orderstatus") == "O", F.lit(True))
         .when(F.col("o_orderstatus") == "F", F.lit(False)).alias("abierta"),
    )


def readings_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> readings (bench size): 100 rides over 5 zones."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("z"), (F.col("l_suppkey") % 5).cast("string")).alias("zona"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("atraccion"),
        F.col("l_quantity").alias("tiempo_espera"),
        F.to_date("l_shipdate").alias("fecha"),
        (F.lit(8) + F.col("l_orderkey") % 14).cast("int").alias("hora_int"),
    )


def weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem -> one weather row per date (temperature, humidity, code)."""
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy(F.to_date("l_shipdate").alias("fecha"))
            .agg(F.round(F.avg("l_quantity"), 6).alias("temperatura"),
                 F.round(F.avg("l_discount") * 1000, 6).alias("humedad"),
                 (F.count(F.lit(1)) % 5 + 1).cast("int").alias("codigo_clima"),
                 F.round(F.round(F.avg("l_quantity"), 6) - 1.5, 6).alias("sensacion_termica")))


def weather_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily weather crossed with the 24 hours of the day (generate, not a join)."""
    w = weather_daily(spark, sf_dir)
    return w.select("fecha", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hora_int"),
                    "temperatura", "humedad", "codigo_clima", "sensacion_termica")


# DuckDB twins of the mappings (views are pre-registered by the oracle runner).
SQL = {
    "readings_events": """
        select event_id row_id, event_type zona,
               concat(event_type, '_', cast(user_id % 7 as varchar)) atraccion,
               value tiempo_espera, cast(ts as date) fecha, cast(hour(ts) as integer) hora_int,
               strftime(ts, '%H:%M') hora, (event_id % 9 <> 0) abierta, ts
        from events""",
    "readings_orders": """
        select o_orderkey row_id, o_orderpriority zona,
               concat(o_orderpriority, '_', cast(o_custkey % 7 as varchar)) atraccion,
               cast(floor(o_totalprice / 25000) * 5 as double) tiempo_espera,
               cast(o_orderdate as date) fecha,
               case when o_orderkey % 97 = 0 then 'n/d' when o_orderkey % 89 = 0 then null
                    else concat(lpad(cast(8 + o_orderkey % 14 as varchar), 2, '0'), ':',
                                lpad(cast((o_orderkey % 4) * 15 as varchar), 2, '0')) end hora,
               case when o_orderkey % 11 = 0 then null else cast(o_orderkey % 41 as double) end temperatura,
               cast(o_orderkey % 101 as double) humedad, cast(o_orderkey % 5 + 1 as integer) codigo_clima,
               case when o_orderstatus = 'O' then true when o_orderstatus = 'F' then false end abierta
        from orders""",
    "readings_lineitem": """
        select concat('z', cast(l_suppkey % 5 as varchar)) zona, concat('s', cast(l_suppkey as varchar)) atraccion,
               l_quantity tiempo_espera, cast(l_shipdate as date) fecha,
               cast(8 + l_orderkey % 14 as integer) hora_int
        from lineitem""",
    "weather_daily": """
        select cast(l_shipdate as date) fecha, round(avg(l_quantity), 6) temperatura,
               round(avg(l_discount) * 1000, 6) humedad, cast(count(*) % 5 + 1 as integer) codigo_clima,
               round(round(avg(l_quantity), 6) - 1.5, 6) sensacion_termica
        from lineitem group by 1""",
}
