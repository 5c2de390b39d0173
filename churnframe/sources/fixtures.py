"""Subscriber snapshot, raw extract and prediction log derived from the
supplied TPC-H-style tables (rules in FIXTURES.md).

Plan shape: lineitem is pre-aggregated per order (partial aggregation before
the shuffle), joined to orders on the order key (the aggregate's hash
partitioning is reused), customers are enriched with nation/region -- plain
table scans whose file sizes let the planner broadcast them under
``spark.sql.autoBroadcastJoinThreshold`` -- and the customer join is a shuffle
join that AQE can split when one customer is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnframe.schema import (AGGRESSIVE_THRESHOLD, DEFAULT_THRESHOLD, HEADER_TO_COLUMN,
                               SNAPSHOT_DATE)
from churnframe.sources.tables import read_table


def subscriber(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders", [
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority"])
    customer = read_table(spark, sf_dir, "customer",
                          ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    lineitem = read_table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_discount", "l_tax", "l_quantity", "l_returnflag", "l_linestatus"])

    li = lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.max("l_discount").alias("max_disc"),
        F.max("l_tax").alias("max_tax"),
        F.max("l_quantity").alias("max_qty"),
        F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("any_r"),
        F.max(F.when(F.col("l_returnflag") == "A", 1).otherwise(0)).alias("any_a"),
        F.max(F.when(F.col("l_linestatus") == "O", 1).otherwise(0)).alias("any_o"))

    geo = nation.join(region, nation.n_regionkey == region.r_regionkey)
    cust = customer.join(geo, customer.c_nationkey == geo.n_nationkey)
    base = (orders.join(li, orders.o_orderkey == li.l_orderkey, "left")
            .join(cust, orders.o_custkey == cust.c_custkey, "inner"))

    ten = ((F.lit(2001) - F.year("o_orderdate")) * 12 + (F.lit(8) - F.month("o_orderdate")))
    seg = F.col("c_mktsegment")
    no_net = seg == "FURNITURE"

    def addon(cond):
        return F.when(no_net, "No internet service").when(cond, "Yes").otherwise("No")

    key = F.col("o_orderkey")
    status_rate = (F.when(F.col("o_orderstatus") == "F", 45)
                   .when(F.col("o_orderstatus") == "O", 15).otherwise(5))
    return base.select(
        key.alias("row_id"),
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("customer_id"),
        F.when(F.col("c_custkey") % 2 == 0, "Male").otherwise("Female").alias("gender"),
        F.when(F.col("c_acctbal") > 8000, 1).otherwise(0).cast("int").alias("senior_citizen"),
        F.when(F.col("n_regionkey") % 2 == 0, "Yes").otherwise("No").alias("partner"),
        F.when(F.col("c_custkey") % 3 == 0, "Yes").otherwise("No").alias("dependents"),
        F.col("r_name").alias("country"),
        F.col("n_name").alias("state"),
        F.when(F.col("o_orderstatus") == "F", "Month-to-month")
         .when(F.col("o_orderstatus") == "O", "One year").otherwise("Two year")
         .alias("contract_type"),
        F.when(key % 5 < 3, "Yes").otherwise("No").alias("paperless_billing"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Electronic check")
         .when(F.col("o_orderpriority") == "2-HIGH", "Mailed check")
         .when(F.col("o_orderpriority") == "3-MEDIUM", "Bank transfer (automatic)")
         .otherwise("Credit card (automatic)").alias("payment_method"),
        F.when(key % 10 == 0, "No").otherwise("Yes").alias("phone_service"),
        F.when(key % 10 == 0, "No phone service")
         .when(F.coalesce(F.col("n_lines"), F.lit(0)) > 4, "Yes").otherwise("No")
         .alias("multiple_lines"),
        F.when(seg.isin("BUILDING", "MACHINERY"), "Fiber optic")
         .when(no_net, "No").otherwise("DSL").alias("internet_service"),
        addon(F.col("any_r") == 1).alias("online_security"),
        addon(F.col("any_a") == 1).alias("online_backup"),
        addon(F.col("any_o") == 1).alias("device_protection"),
        addon(F.col("max_disc") > 0.08).alias("tech_support"),
        addon(F.col("max_tax") > 0.06).alias("streaming_tv"),
        addon(F.col("max_qty") > 40).alias("streaming_movies"),
        ten.cast("int").alias("tenure_months"),
        (F.col("o_totalprice") / 4096).alias("monthly_charges"),
        F.when((ten == 0) | (key % 97 == 0), F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice") / 4096 * ten).alias("total_charges"),
        (F.lit(2000) + F.col("c_custkey") % 4500).cast("double").alias("cltv"),
        F.when((key * 7919) % 100 < status_rate + F.when(ten <= 12, 20).otherwise(0), "Yes")
         .otherwise("No").alias("churn_label"),
        F.lit(SNAPSHOT_DATE).alias("snapshot_date"))


def subscriber_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extract before cleaning: every value a string, spaced headers, dirt."""
    s = subscriber(spark, sf_dir)
    rid = F.col("row_id")
    dirty = {
        "total_charges": F.when(F.col("total_charges").isNull(), F.lit(" "))
                          .otherwise(F.col("total_charges").cast("string")),
        "senior_citizen": F.when(rid % 50 == 0, F.lit("Yes"))
                           .otherwise(F.col("senior_citizen").cast("string")),
        "tenure_months": F.when(rid % 101 == 0, F.lit("n/a"))
                          .otherwise(F.col("tenure_months").cast("string")),
        "monthly_charges": F.when(rid % 103 == 0, F.lit("abc"))
                            .otherwise(F.col("monthly_charges").cast("string")),
    }
    cols = [rid]
    for header, name in HEADER_TO_COLUMN.items():
        expr = dirty.get(name, F.col(name).cast("string"))
        cols.append(expr.alias(header))
    return s.select(*cols)


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction log rows derived from ``events`` (one scored request each)."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    purchase = F.col("event_type") == "purchase"
    prob = F.least(F.col("value") / 128, F.lit(1.0))
    thr = F.when(purchase, F.lit(AGGRESSIVE_THRESHOLD)).otherwise(F.lit(DEFAULT_THRESHOLD))
    return ev.select(
        F.col("event_id").alias("id"),
        F.col("ts").cast("timestamp").alias("ts_utc"),
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("-"),
                 F.col("event_id").cast("string")).alias("request_id"),
        F.when(purchase, "aggressive").otherwise("default").alias("mode"),
        thr.alias("threshold"),
        prob.alias("churn_probability"),
        (prob >= thr).cast("int").alias("churn_flag"))
