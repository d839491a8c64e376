"""Stand-in inputs: the daily job's tables, derived from the generated test tables.

Each function reads whole tables. ``oracle.py`` states the same views in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.functions import reltime
from tidecast.operators import series

SOURCES = ["twitter", "cnn", "bitcoin_news", "twitter_influencers"]
METRICS = [
    "sopr",
    "rate",
    "hash_rate_mean",
    "active_count",
    "utxo_created_value_sum",
    "utxo_spent_value_sum",
]
EVENT_METRICS = ["click", "view", "purchase", "signup", "error"]
# Word weights per aspect: frequent function words of the test texts.
LEXICON = [
    ("the", "ECONOMY", 1),
    ("and", "ECONOMY", -1),
    ("der", "ECONOMY", 1),
    ("que", "ECONOMY", -1),
    ("for", "TECHNOLOGY", 1),
    ("that", "TECHNOLOGY", -1),
    ("und", "TECHNOLOGY", 1),
    ("les", "TECHNOLOGY", -1),
    ("are", "GENERAL", 1),
    ("is", "GENERAL", -1),
    ("die", "GENERAL", 1),
    ("est", "GENERAL", -1),
    ("of", "COMMUNITY", 1),
    ("in", "COMMUNITY", -1),
    ("la", "COMMUNITY", 1),
    ("el", "COMMUNITY", -1),
    ("to", "SECURITY", 1),
    ("it", "SECURITY", -1),
    ("the", "SECURITY", 1),
    ("de", "SECURITY", -1),
]


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table. The schema is given, so opening it reads no file footer."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _case(expression: str, values: dict) -> Column:
    arms = " ".join(f"WHEN {k!r} THEN {v!r}" for k, v in values.items())
    return F.expr(f"CASE {expression} {arms} END")


K = "CAST(regexp_extract(props, '[0-9]+', 0) AS INT)"


def _day(offset: Column) -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), offset.cast("int"))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classified posts of three series and four sources."""
    aspects = {
        "click": "ECONOMY",
        "view": "TECHNOLOGY",
        "purchase": "GENERAL",
        "signup": "COMMUNITY",
        "error": "SECURITY",
    }
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.to_date("ts").alias("date"),
        F.concat(F.lit("s"), F.col("user_id")).alias("series_id"),
        F.col("user_id").alias("author"),
        "value",
        _case("event_id % 4", dict(enumerate(SOURCES))).alias("media"),
        _case("event_type", aspects).alias("aspect"),
        _case(f"{K} % 3", {0: "POSITIVE", 1: "NEGATIVE", 2: "NONE"}).alias("polarity"),
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News and post texts over thirty days and three media; posts have no title."""
    media = _case("doc_id % 3", {0: "twitter", 1: "cnn", 2: "bitcoin_news"})
    title = F.when(F.col("doc_id") % 3 != 0, F.substring_index("text", "\n", 1))
    day = _day(F.col("doc_id") % 30)
    ts = day.cast("timestamp_ntz") + F.make_interval(secs=F.col("doc_id") % 86400)
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        day.alias("date"),
        ts.alias("ts"),
        "lang",
        "source",
        media.alias("media"),
        title.alias("title"),
        F.col("text").alias("article"),
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchange candles per event type: epoch-millisecond close time and price."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("series_id"),
        F.unix_millis(reltime.as_utc(F.col("ts"))).alias("closetime"),
        "event_id",
        F.col("value").alias("close_price"),
    )


def close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily close of the three series the posts are about."""
    return series.daily_close(
        posts(spark, sf_dir).withColumn("instant", F.unix_micros(reltime.as_utc(F.col("ts")))),
        ["series_id"],
        "instant",
        "event_id",
        price="value",
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long daily prices with gaps, one series per order priority."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("series_id"),
        F.to_date("o_orderdate").alias("date"),
        "o_orderkey",
        F.col("o_totalprice").alias("close_price"),
    )
    return series.daily_close(orders, ["series_id"], "o_orderkey")


def trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search interest per series; series s0 has not got its last day yet."""
    views = (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == "view")
        .select(
            F.concat(F.lit("s"), F.col("user_id")).alias("series_id"),
            F.to_date("ts").alias("date"),
        )
        .groupBy("series_id", "date")
        .agg(F.count("*").alias("views"))
    )
    last = views.select(F.max("date")).scalar()
    unfilled = (F.col("series_id") == "s0") & (F.col("date") == last)
    return views.select(
        "series_id", "date", F.when(unfilled, 0).otherwise(F.col("views")).alias("trends")
    )


def metric_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily value of six metrics per series."""
    return (
        posts(spark, sf_dir)
        .withColumn("metric", _case("event_id % 6", dict(enumerate(METRICS))))
        .groupBy("series_id", "date", "metric")
        .agg(F.round(F.sum("value"), 4).alias("v"))
    )


def event_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily value per event type, as metric points ``(t, v)`` with epoch seconds."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.to_date("ts").alias("date"), F.col("event_type").alias("metric"))
        .agg(F.round(F.sum("value"), 4).alias("v"))
        .withColumn("t", F.unix_date("date").cast("long") * 86400)
        .drop("date")
    )


def influencers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Influencer list: customers, ranked by balance, with a nation as token."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("handle"),
        F.col("c_acctbal").alias("rank"),
        F.col("c_nationkey").alias("token"),
    )


def order_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Influencers' posts over many days: orders."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("tweet_id"),
        F.to_date("o_orderdate").alias("date"),
        F.col("o_custkey").alias("author"),
        F.col("o_orderpriority").alias("series_id"),
    )


def pages_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API pages: up to a hundred orders each, with their customers and nations nested."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.count("*").alias("n_lines"), F.sum("l_quantity").cast("long").alias("quantity"))
    )
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    key = F.col("o_orderkey")
    place_id = F.when(key % 3 == 0, key % 25)
    orders = table(spark, sf_dir, "orders")
    rows = (
        orders.join(lines, key == F.col("l_orderkey"), "left")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(nations, place_id == F.col("n_nationkey"), "left")
    )
    counter = F.struct(
        F.coalesce("n_lines", F.lit(0)).alias("retweet_count"),
        F.lit(0).cast("long").alias("reply_count"),
        F.coalesce("quantity", F.lit(0)).alias("like_count"),
        F.lit(0).cast("long").alias("quote_count"),
    )
    kind = F.concat(F.lit("type"), F.length("o_orderpriority"))
    post = F.struct(
        key.cast("string").alias("id"),
        F.concat(F.lit("order "), key).alias("text"),
        F.col("o_custkey").cast("string").alias("author_id"),
        F.when(key % 2 == 0, (key * 7) % 1500).cast("string").alias("in_reply_to_user_id"),
        F.when(place_id.isNotNull(), F.struct(place_id.cast("string").alias("place_id"))).alias(
            "geo"
        ),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"),
        F.lit("en").alias("lang"),
        F.when(key % 5 == 0, F.array(F.struct(kind.alias("type")))).alias("referenced_tweets"),
        counter.alias("public_metrics"),
    )
    user = F.when(
        F.col("c_custkey").isNotNull(),
        F.struct(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("username")),
    )
    place = F.when(
        F.col("n_nationkey").isNotNull(),
        F.struct(
            F.col("n_nationkey").cast("string").alias("id"),
            F.concat(F.lit("N"), F.col("n_nationkey")).alias("country_code"),
            F.col("n_name").alias("country"),
            F.concat_ws(", ", "n_name", "r_name").alias("full_name"),
        ),
    )
    grouped = rows.groupBy(F.floor(key / 100).alias("page")).agg(
        F.collect_list(post).alias("data"),
        F.collect_list(user).alias("users"),
        F.collect_list(place).alias("places"),
        F.count("*").alias("result_count"),
    )
    page = F.struct(
        "data",
        F.struct(
            F.concat("users", "users").alias("users"),
            F.when(F.size("places") > 0, F.col("places")).alias("places"),
        ).alias("includes"),
        F.struct("result_count", F.lit(None).cast("string").alias("next_token")).alias("meta"),
    )
    return grouped.select(F.to_json(page).alias("value"))


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Post texts with names, links, tags, contractions, clock times and an emoji."""
    body = F.concat(
        F.lit("@u"),
        F.col("user_id"),
        F.lit(" I can't  see http://x.co/"),
        F.col("event_id"),
        F.lit(" cannot "),
        F.col("event_type"),
        F.lit(" #"),
        F.col("event_type"),
        F.lit(" 🚀 at 5 p . m . it’s… "),
        F.when(F.col("event_id") % 2 == 0, "we're @josé_x WWW.A.B").otherwise("they'll \r go"),
    )
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", F.to_date("ts").alias("date"), body.alias("article")
    )


def relative_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scrape times with relative texts in every unit; some texts are absolute or broken."""
    k = F.regexp_extract("props", "[0-9]+", 0)
    units = dict(enumerate(["second", "min", "minute", "hour", "day", "week", "month", "year"]))
    unit = _case("event_id % 8", units)
    said = (
        F.when(F.col("event_id") % 11 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("event_id") % 13 == 0, F.lit("just now"))
        .when(F.col("event_id") % 17 == 0, F.concat(F.lit("1 day "), k, F.lit(" hours ago")))
        .otherwise(F.concat(k, F.lit(" "), unit, F.lit("s ago")))
    )
    return table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.col("ts").alias("scraped_at"), said.alias("said")
    )


def probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored predictions per language: probability and what happened."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return documents.join(labels, "doc_id").select(
        "doc_id",
        "lang",
        _day(F.col("doc_id") % 30).alias("date"),
        ((F.col("n_chars") % 100) / 100.0).alias("p"),
        (F.col("quality") == 1).alias("actual"),
    )


def class_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three class scores per post, with ties."""
    k = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    scores = F.array((k % 7) / 7.0, (k % 5) / 5.0, (k % 3) / 3.0)
    return table(spark, sf_dir, "events").select("event_id", scores.alias("probabilities"))


def lexicon(spark: SparkSession) -> DataFrame:
    """The word list as rows whose size the planner knows."""
    names = ("token", "aspect", "weight")
    rows = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in LEXICON]
    return spark.range(1).select(F.inline(F.array(*rows)))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored forecasts: up after a rise, down otherwise; none on a series' first day."""
    moved = series.log_return(prices(spark, sf_dir), ["series_id"])
    return moved.where(F.col("price_diff").isNotNull()).select(
        "series_id",
        "date",
        "close_price",
        F.when(F.col("price_diff") > 0, "Up").otherwise("Down").alias("prediction"),
    )


def words(df: DataFrame) -> DataFrame:
    """Articles with their text as ``content``."""
    return df.withColumn("content", F.coalesce("article", F.lit("")))
