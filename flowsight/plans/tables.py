"""The given tables seen as labelled rows, raw tokens, flow events and scored rows.

Every view is a projection of one table (or of documents with their labels), so filters and
column pruning reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowsight.contract import Contract, RawLayout, ddl

LINES = Contract(
    schema=ddl(
        "id bigint, proto string, service string, state string, dur double, margin double, attack_cat string, label int"
    ),
    identifier="id",
    categorical=("proto", "service", "state"),
    category="attack_cat",
    label="label",
    category_names={"backdoor": "Backdoor", "backdoors": "Backdoor"},
)

# Number features of the order lines for the classifiers.
LINE_FEATURES = Contract(
    schema=ddl(
        "id bigint, status string, supplier_band string, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, ship_month int, attack_cat string, label int"
    ),
    identifier="id",
    categorical=("status", "supplier_band"),
    category="attack_cat",
    label="label",
)

# Orders, which unlike their lines have a key each.
ORDERS = Contract(
    schema=ddl("id bigint, priority string, status string, price double, attack_cat string, label int"),
    identifier="id",
    categorical=("priority", "status"),
    category="attack_cat",
    label="label",
)

PAGE_TOKENS = RawLayout(
    columns=("host", "sport", "dsport", "proto", "state", "service", "dur", "Spkts", "Dpkts", "attack_cat", "label"),
    ports=frozenset({"sport", "dsport"}),
    longs=frozenset(),
    doubles=frozenset(),
    texts=frozenset({"host", "proto", "state", "service", "attack_cat"}),
    renames={c.lower(): c for c in "sport dsport proto state service dur Spkts Dpkts attack_cat label".split()},
)

PAGES = Contract(
    schema=ddl(
        "id bigint, dur double, proto string, service string, state string, spkts int, dpkts int, rate double, "
        "sport bigint, dsport bigint, attack_cat string, label int"
    ),
    identifier="id",
    categorical=("proto", "service", "state"),
    category="attack_cat",
    label="label",
)


# The columns of the given tables that the named queries read.
SCHEMAS = {
    "orders": ddl(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
    "lineitem": ddl(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": ddl("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"),
    "documents": ddl("doc_id bigint, text string, lang string, source string, n_chars bigint"),
    "labels": ddl("doc_id bigint, quality int, toxic int"),
    "pages": ddl("page_id bigint, url string, html string"),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def line_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines under ``LINES``, as untidy as their values make them."""
    tags = F.when((F.col("l_discount") == 0.1) & (F.col("l_tax") == 0), "-").when(
        F.col("l_returnflag") == "R", " Backdoors "
    ).when(F.col("l_returnflag") == "A", "normal").otherwise("NORMAL")
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.concat(F.lit(" "), "l_returnflag").alias("proto"),
        F.nullif("l_linestatus", F.lit("F")).alias("service"),
        F.when(F.col("l_tax") == 0, "-").otherwise(F.col("l_linestatus")).alias("state"),
        F.col("l_quantity").alias("dur"),
        (F.col("l_discount") - F.col("l_tax")).alias("margin"),
        tags.alias("attack_cat"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
    )


def order_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Orders under ``ORDERS``, untidy too; the label asks for a finished one."""
    finished = F.col("o_orderstatus") == "F"
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit(" "), "o_orderpriority").alias("priority"),
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        (F.col("o_totalprice") - 100_000).alias("price"),
        F.when(finished, " Finished ").otherwise("NORMAL").alias("attack_cat"),
        finished.cast("int").alias("label"),
    )


def line_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with their order as key and ``label`` from the line status."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus",
        (F.col("l_linestatus") == "F").cast("int").alias("label"),
    )


def line_features(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines under ``LINE_FEATURES``; the label asks for a dear line."""
    dear = (F.col("l_extendedprice") * (1 - F.col("l_discount")) > 50_000).cast("int")
    return table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
        F.col("l_linestatus").alias("status"),
        F.substring(F.col("l_suppkey").cast("string"), 1, 1).alias("supplier_band"),
        "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        F.month("l_shipdate").alias("ship_month"),
        F.when(dear == 1, "Dear").otherwise("Normal").alias("attack_cat"),
        dear.alias("label"),
    )


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their labels; most documents have none."""
    return table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")


def page_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as text tokens: parts of the address, and lengths."""
    url = F.col("url")
    host = F.regexp_extract(url, "^[a-z]+://([^/]+)", 1)
    spam = host.rlike("casino|pills")
    return table(spark, folder, "pages").select(
        host.alias("host"),
        F.concat(F.lit("0X"), F.substring(F.md5(url), 1, 4)).alias("sport"),
        F.regexp_extract(url, "/([^/]*)$", 1).alias("dsport"),
        F.regexp_extract(url, "^([a-z]+):", 1).alias("proto"),
        F.regexp_extract(url, "://[^/]+/([^/]*)/", 1).alias("state"),
        F.regexp_extract(url, "://([a-z]+)", 1).alias("service"),
        F.regexp_extract(url, "page=([0-9]+)", 1).alias("dur"),
        F.concat(F.lit(" "), F.length("html").cast("string")).alias("Spkts"),
        F.length("url").cast("string").alias("Dpkts"),
        F.when(spam, " Spam ").alias("attack_cat"),
        F.when(spam, "1").otherwise("0").alias("label"),
        F.regexp_extract(url, "://[^/]+[.]([a-z]+)/", 1).alias("source_file"),
    )


def flow_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events under the flow event columns; a source is a user, an experiment a month."""
    return as_flow_events(table(spark, folder, "events"))


def as_flow_events(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    user = F.col("user_id").cast("string")
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.concat_ws("|", user, F.date_format("ts", "yyyy-MM-dd")).alias("run_id"),
        F.concat(F.lit("u"), user).alias("actor_id"),
        F.date_format("ts", "yyyy-MM").alias("experiment_id"),
        F.when(F.col("value") >= 20, "calibration").otherwise("training").alias("lab_mode"),
        F.when(kind == "signup", "control").otherwise("flow").alias("record_type"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        user.alias("source_ip"),
        F.when(kind.isin("view", "click"), 8080).when(kind != "signup", 22).cast("int").alias("destination_port"),
        F.when(kind.isin("view", "click"), "http").otherwise(kind).alias("service"),
        F.col("value").alias("dur"),
        F.regexp_extract("props", "([0-9]+)", 1).try_cast("bigint").alias("sbytes"),
        F.length("props").cast("bigint").alias("dbytes"),
    )


def event_truth(spark: SparkSession, folder: str) -> DataFrame:
    """What is known about single events: errors are positive, events of tiny value are unknown."""
    return table(spark, folder, "events").where(F.col("value") >= 1).select(
        F.col("event_id").cast("string").alias("event_id"),
        (F.col("event_type") == "error").cast("int").alias("label"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("user_id").cast("string").alias("source_ip"),
    )


def run_truth(spark: SparkSession, folder: str) -> DataFrame:
    """What is known about runs: the flows they should have, one more where a dear event was lost."""
    flows = flow_events(spark, folder).where(F.col("record_type") == "flow")
    return flows.groupBy("run_id").agg(
        F.max((F.col("service") == "error").cast("int")).alias("label"),
        F.max("lab_mode").alias("lab_mode"),
        (F.count(F.lit(1)) + F.max((F.col("dur") > 200).cast("bigint"))).alias("expected_flows"),
    )


def scored_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with a score from their value and a decision at 0.3; errors are positive."""
    return as_scored_events(table(spark, folder, "events"))


def as_scored_events(events: DataFrame, *carry: str) -> DataFrame:
    score = F.floor(F.col("value") / (F.col("value") + 50.0) * 500) / 500.0
    scored = events.select(
        F.col("event_id").alias("id"), "event_type", "user_id",
        (F.col("event_type") == "error").cast("int").alias("label"),
        score.alias("attack_probability"),
        *carry,
    )
    return scored.withColumn("prediction", (F.col("attack_probability") >= 0.3).cast("int"))


def order_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as runs: finished orders are positive, urgent ones are calibration runs."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "calibration").otherwise("training").alias("lab_mode"),
    )
