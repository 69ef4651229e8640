"""The library's row sets derived from a star schema of orders, events and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_DATE = "2017-08-16"
CURRENT_FROM = "1998-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the star schema. Its times are stored without a zone and are taken as UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily quantity per store (nation of the supplier) and family (type of the part)."""
    lines = table(spark, sf_dir, "lineitem")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return (
        lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(
            F.to_date("l_shipdate").alias("date"),
            F.col("s_nationkey").cast("long").alias("store_nbr"),
            F.col("p_type").alias("family"),
        )
        .agg(
            F.count_if(F.col("l_discount") > 0.05).alias("onpromotion"),
            F.sum("l_quantity").alias("sales"),
        )
    )


def reference_window(df: DataFrame, date: str = "date") -> DataFrame:
    return df.filter(F.col(date) < F.lit(CURRENT_FROM).cast("date"))


def current_window(df: DataFrame, date: str = "date") -> DataFrame:
    return df.filter(F.col(date) >= F.lit(CURRENT_FROM).cast("date"))


def line_windows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Lines shipped before and from the cut: numbers with many and few values, and categories."""
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_suppkey", "l_returnflag", "l_linestatus"]
    lines = table(spark, sf_dir, "lineitem")
    cut = F.lit(CURRENT_FROM).cast("date")
    shipped = F.col("l_shipdate").cast("date")
    return lines.filter(shipped < cut).select(*cols), lines.filter(shipped >= cut).select(*cols)


def request_log(events: DataFrame) -> DataFrame:
    """Events as a log of requests; works on a batch and on a stream."""
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"),
        (F.col("value") / 100).alias("latency_s"),
        F.col("value").alias("value"),
        F.col("event_type").alias("event_type"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One forecast request per order."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").cast("string").alias("request_id"),
        F.col("c_nationkey").cast("long").alias("store_nbr"),
        F.col("c_mktsegment").alias("family"),
        F.col("o_orderpriority").startswith("1").cast("long").alias("onpromotion"),
        (1 + F.col("o_orderkey") % 30).cast("int").alias("days_ahead"),
        F.lit(BASE_DATE).cast("date").alias("base_date"),
    )


def raw_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same requests as text fields, some left out and some of the wrong type."""
    clean = requests(spark, sf_dir).drop("base_date")
    key = F.col("request_id").cast("long")
    return clean.select(
        "request_id",
        F.when(key % 11 == 0, "not-an-int").when(key % 13 == 0, None).otherwise(F.col("store_nbr").cast("string")).alias("store_nbr"),
        F.when(key % 7 != 0, F.col("family")).alias("family"),
        F.when(key % 17 == 0, "1.5").otherwise(F.col("onpromotion").cast("string")).alias("onpromotion"),
        F.when(key % 5 != 0, F.col("days_ahead").cast("string")).alias("days_ahead"),
    )


def answer_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows (id, question, context, answer): a user turn, the assistant turn right after it, a document."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.filter(F.col("role") == "user").select(
        "conv_id", F.col("turn").alias("asked_turn"), (F.col("turn") + 1).alias("turn"), F.col("text").alias("question")
    )
    answered = turns.filter(F.col("role") == "assistant").select("conv_id", "turn", F.col("text").alias("answer"))
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("conv_id"), F.col("text").alias("context"))
    return (
        asked.join(answered, ["conv_id", "turn"])
        .join(documents, "conv_id")
        .select((F.col("conv_id") * 1000 + F.col("asked_turn")).alias("id"), "question", "context", "answer")
    )
