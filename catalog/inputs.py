"""The source tables of the campaign plans, derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import hash_order, month_id
from tidemark.plans.campaign import FAMILIES, Rules, Sources
from tidemark.sources import read_dataset

MONTH = "199808"

AMOUNTS = ("price", "tax", "discount")
COUNTS = ("lines", "units", "odd_lines")

RULES = Rules(
    site="O",
    marketplaces=("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"),
    platforms=("ios", "android"),
    path="CAMPAIGN",
    business="wallet",
    excluded_segment="1-URGENT",
    consent_in="IN",
    consent_out="OUT",
    consent_statuses=("F", "O"),
    employee_status="ACTIVE",
    campaign_patterns=("%SALE%", "%PROMO"),
    batch_exclusions=("%BLOCKED%",),
    oldest_batch_exclusions=("%CG",),
    # Every family sums two or three of the measures; the pattern repeats over the families.
    amounts={f: [AMOUNTS[i % 3], AMOUNTS[(i + 1) % 3]] for i, f in enumerate(FAMILIES)},
    counts={f: [COUNTS[i % 3], COUNTS[(i + 1) % 3]] for i, f in enumerate(FAMILIES)},
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_dataset(spark, f"{sf}/{name}.parquet")


def lines_by_customer(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with their customer."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("customer_id"))
    return table(spark, sf, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def notifications(spark: SparkSession, sf: str) -> DataFrame:
    q, d = F.col("l_quantity"), F.col("l_discount")
    return lines_by_customer(spark, sf).select(
        "customer_id",
        F.when(F.col("l_returnflag") == "N", "shown").when(F.col("l_returnflag") == "R", "open").otherwise("lost").alias("event_type"),
        F.to_date("l_shipdate").alias("event_date"),
        F.col("l_linestatus").alias("site"),
        F.when(F.col("l_linenumber") == 7, "RECEIPT").otherwise("CAMPAIGN").alias("path"),
        F.lit("wallet").alias("business"),
        F.when(q < 3, "A_BLOCKED_1").when(q < 8, "B_CG").otherwise(F.concat(F.lit("B_"), F.col("l_linenumber"))).alias("batch_id"),
        F.when(d < 0.02, "SPRING-SALE-A").when(d < 0.04, "APP-PROMO").when(d < 0.06, "PROMO-END").otherwise("OTHER").alias("campaign_id"),
    )


def monthly_activity(spark: SparkSession, sf: str) -> DataFrame:
    """Whole-number measures, so that sums do not depend on the order of rows."""
    return lines_by_customer(spark, sf).select(
        "customer_id",
        month_id(F.col("l_shipdate")).alias("month_id"),
        F.col("l_linestatus").alias("site"),
        F.floor("l_extendedprice").cast("double").alias("price"),
        F.rint(F.col("l_tax") * 100).alias("tax"),
        F.rint(F.col("l_discount") * 100).alias("discount"),
        F.col("l_linenumber").cast("bigint").alias("lines"),
        F.col("l_quantity").cast("bigint").alias("units"),
        F.nullif(F.col("l_linenumber"), F.lit(3)).cast("bigint").alias("odd_lines"),
    )


def external_cards(spark: SparkSession, sf: str) -> DataFrame:
    def limits(*amounts):
        return F.array(*[F.struct(a.alias("amount")) for a in amounts])

    price = F.col("l_extendedprice")
    flag = F.col("l_returnflag")
    nothing = F.filter(limits(price), lambda x: F.lit(False))
    return lines_by_customer(spark, sf).select(
        "customer_id",
        F.to_date("l_shipdate").alias("since"),
        F.when(F.col("l_quantity") > 1, F.col("l_partkey")).alias("card_id"),
        F.when(flag == "A", limits(price)).when(flag == "N", limits(price, price / 2)).otherwise(nothing).alias("limits"),
    )


def app_devices(spark: SparkSession, sf: str) -> DataFrame:
    bal, nation = F.col("c_acctbal"), F.col("c_nationkey")
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("marketplace"),
        F.when(bal < -500, "BLOCKED").otherwise("ACTIVE").alias("status"),
        F.when(nation == 24, "NO").otherwise("YES").alias("active"),
        F.when(nation < 10, "ios").when(nation < 20, "android").otherwise("web").alias("platform"),
        F.lit("O").alias("site"),
        F.when(bal.between(0, 500), "  ").when(bal.between(501, 900), F.lit(None)).otherwise(F.col("c_name")).alias("token"),
    )


def consents(spark: SparkSession, sf: str) -> DataFrame:
    priority = F.substring("o_orderpriority", 1, 1)
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.when(priority.isin("1", "2"), "IN").when(priority == "5", "OUT").otherwise("OTHER").alias("consent_type"),
        F.col("o_orderstatus").alias("consent_status"),
        F.col("o_orderdate").alias("status_ts"),
    )


def employees(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("customer_id"),
        F.when(F.col("s_acctbal") > 0, "Active").otherwise("Gone").alias("status"),
        F.when(F.col("s_nationkey") < 5, F.to_date(F.lit("1997-01-01"))).alias("end_date"),
    )


def segments(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("segment"),
        month_id(F.col("o_orderdate")).alias("month_id"),
        F.lit("O").alias("site"),
    )


def sources(spark: SparkSession, sf: str) -> Sources:
    orders = table(spark, sf, "orders")
    customer = F.col("o_custkey").alias("customer_id")
    site = F.lit("O").alias("site")
    return Sources(
        consents=consents(spark, sf),
        app_devices=app_devices(spark, sf),
        notifications=notifications(spark, sf),
        daily_balances=orders.select(customer, F.col("o_orderdate").alias("day"), F.col("o_totalprice").alias("available_balance")),
        segments=segments(spark, sf),
        employees=employees(spark, sf),
        lifecycle=orders.select(
            customer,
            F.col("o_orderstatus").alias("stage"),
            F.col("o_orderpriority").alias("category"),
            F.col("o_orderkey").alias("photo_id"),
            site,
        ),
        monthly_activity=monthly_activity(spark, sf),
        card_accounts=table(spark, sf, "customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.when(F.col("c_acctbal") > 5000, "active").otherwise("closed").alias("status"),
        ),
        loyalty_log=orders.select(
            customer,
            (F.floor(F.col("o_totalprice") / 50000) + F.lit(0.5)).alias("level"),
            F.col("o_orderdate").alias("level_from"),
            site,
        ),
    )


def scored_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as scored rows: a probability pair and a label."""
    price = F.col("o_totalprice")
    p1 = price / (price + F.lit(200000.0))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        (F.lit(1.0) - p1).alias("p0"),
        p1.alias("p1"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("target"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("level"),
        price.alias("price"),
    )


def scored_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents, scored by their length."""
    docs = table(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("n"))
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("target"))
    p1 = F.col("n") / (F.col("n") + F.lit(1000.0))
    return docs.join(labels, "doc_id").select(F.col("doc_id").alias("id"), p1.alias("p1"), "target")


def regression_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Order totals as actual values and a guess from the order's lines as the prediction."""
    guess = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_orderkey").alias("id"))
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("units"), F.count(F.lit(1)).alias("n"))
    )
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("y")).join(guess, "id").select(
        "id", "y", (F.col("units") * F.lit(2000.0)).alias("pred")
    )


def model_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows to fit models on: two categories, three numbers, a label of two classes and a number."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"),
        F.month("o_orderdate").cast("double").alias("month"),
        F.dayofweek("o_orderdate").cast("double").alias("weekday"),
        F.when((F.col("o_totalprice") > 250000) & (F.col("o_orderstatus") != "P"), 1)
        .when((F.month("o_orderdate") == 12) & (hash_order(F.col("o_orderkey"), "noise") > 2**51), 1)
        .otherwise(0)
        .alias("target"),
    )


def registry(spark: SparkSession, sf: str) -> DataFrame:
    """One training run per model (order priority) and month, with a metric."""
    return (
        table(spark, sf, "orders")
        .groupBy(F.col("o_orderpriority").alias("MODEL_NAME"), F.trunc("o_orderdate", "MM").alias("SAFRA"))
        .agg(
            F.count_if(F.col("o_orderstatus") == "F").alias("hits"),
            F.count(F.lit(1)).alias("n"),
            F.date_format(F.max("o_orderdate"), "yyyyMMddHHmmss").alias("DT_TRAIN"),
        )
        .select("MODEL_NAME", "DT_TRAIN", F.floor(F.col("hits") * 100 / F.col("n")).cast("int").alias("METRIC"), "SAFRA")
    )


def score_history(spark: SparkSession, sf: str) -> DataFrame:
    """Stored scores of several runs: a customer's row in the run of its order's day."""
    orders = table(spark, sf, "orders")
    return orders.select(
        F.col("o_orderpriority").alias("MODEL_NAME"),
        F.col("o_orderkey").alias("customer_id"),
        F.floor(F.col("o_totalprice")).alias("SCORES_0"),
        F.trunc("o_orderdate", "MM").alias("SAFRA"),
        F.date_format("o_orderdate", "yyyyMMddHHmmss").alias("DT_EXEC"),
        F.lit("19980101000000").alias("DT_TRAIN"),
    )
