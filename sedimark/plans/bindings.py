"""The benchmark tables as inputs of the engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimark.functions.text import norm_key, norm_text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """The rows dealt over all cores, several tasks each: a small file is one task, however much work its rows make."""
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * rows.sparkSession.sparkContext.defaultParallelism)
    return rows.repartition(n, key)


ORDINAL = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def mentions_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Technology mentions: the parts of line items."""
    items = table(spark, sf_dir, "lineitem").select(*ORDINAL)
    return items.join(table(spark, sf_dir, "part").select("p_partkey", "p_name"), items["l_partkey"] == F.col("p_partkey"))


def mentions_of_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Process mentions: the suppliers of line items."""
    items = table(spark, sf_dir, "lineitem").select(*ORDINAL)
    return items.join(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), items["l_suppkey"] == F.col("s_suppkey"))


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents for the graph: orders with their parts and suppliers; the priority is an explicit edge."""
    parts = mentions_of_parts(spark, sf_dir).select(*ORDINAL, F.col("p_name").alias("name"))
    both = parts.join(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), "l_suppkey")
    lists = both.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*ORDINAL, "name", "s_name"))).alias("i"))
    orders = table(spark, sf_dir, "orders")
    rows = orders.join(lists, orders["o_orderkey"] == lists["l_orderkey"], "left")
    none = F.array().cast("array<string>")
    edge = F.struct(F.concat(F.lit("OFFER:"), F.col("o_orderkey").cast("string")).alias("from"), F.lit("HAS_PRIORITY").alias("relation"), F.concat(F.lit("PRIORITY:"), "o_orderpriority").alias("to"))
    plain = F.struct(F.concat(F.lit("STATUS:"), "o_orderstatus").alias("from"), F.lit("STATUS_OF").alias("relation"), F.col("o_orderpriority").alias("to"))
    return rows.select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("role"), F.concat(F.lit("customer "), F.col("o_custkey").cast("string")).alias("company"),
        F.coalesce(F.transform("i", lambda x: F.struct(x["name"].alias("name"))), F.array().cast("array<struct<name:string>>")).alias("technologies"),
        F.coalesce(F.transform("i", lambda x: x["s_name"]), none).alias("processes"), none.alias("keywords"),
        F.array(edge, plain).alias("graph_edges"), F.col("o_orderkey").alias("ordinal"),
    )


def observations(spark: SparkSession, sf_dir: str, coarse: bool = False) -> DataFrame:
    """(user_id, seq, hash, ...): events as observations of users; the content is the event's type, or type and whole value."""
    content = F.concat_ws("|", "event_type", F.floor("value").cast("string")) if coarse else F.col("event_type")
    return table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("seq"), F.sha2(content, 256).alias("hash"), "event_type", "value", "ts", "props")


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as postings of two sources, with organisations, seeded ids and domains."""
    p = table(spark, sf_dir, "part")
    suffix = F.when(F.col("p_partkey") % 5 == 0, " sp. z o.o.").when(F.col("p_partkey") % 5 == 1, " Ltd.").otherwise("")
    mention = F.when(F.col("p_size") != 49, F.concat("p_brand", suffix))
    level = F.when(F.col("p_size") % 4 == 0, "Senior ").when(F.col("p_size") % 4 == 1, "Junior ").otherwise("")
    kind = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit(" "), "p_type")).otherwise("")
    title = F.when(F.col("p_size") == 50, "").otherwise(F.concat(level, "p_name", kind))
    number = F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int")
    rows = p.select(
        F.col("p_partkey").alias("id"), F.concat(F.lit("s"), (F.col("p_partkey") % 2).cast("string")).alias("source"), F.col("p_partkey").cast("string").alias("source_posting_id"),
        F.concat(F.lit("https://www.s.example/job-offer/"), F.col("p_partkey").cast("string")).alias("url"),
        norm_text(title).alias("title"), norm_key(mention).alias("org_mention"), mention.alias("mention_text"), number.alias("brand"),
    )
    # one organisation for each mention key: its id is the smallest posting that mentions it
    seeds = rows.where("org_mention <> ''").groupBy("org_mention").agg(F.min("id").alias("organization_id"))
    rows = rows.join(seeds, "org_mention", "left")
    domains = F.when(F.col("organization_id").isNotNull() & (F.col("brand") % 7 < 2), F.array(F.concat(F.lit("d"), (F.col("brand") % 7).cast("string"), F.lit(".example"))))
    return rows.withColumn("domains", domains).drop("brand")
