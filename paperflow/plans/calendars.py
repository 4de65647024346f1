"""Days, gaps, windows and run modes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import calendar
from ..operators.asof import asof_join, micros, range_join
from ..sources.tables import table
from .catalog import define, job

KINDS = ("view", "click", "signup", "purchase", "error")


def user_days(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("user_id", "event_type", F.col("ts").cast("date").alias("day"))


def _iso(name: str):
    return F.date_format(name, "yyyy-MM-dd").alias(name)


@job("prev_day", """WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events)
SELECT user_id, strftime(day, '%Y-%m-%d') AS day, strftime(lag(day) OVER (PARTITION BY user_id ORDER BY day), '%Y-%m-%d') AS prev_day FROM d""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return calendar.previous_day(user_days(spark, folder), ["user_id"]).select("user_id", _iso("day"), _iso("prev_day"))


@job("calendar_gaps", """WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
r AS (SELECT user_id, unnest(generate_series(min(day), DATE '2024-01-31', INTERVAL 1 DAY)) AS m FROM d GROUP BY user_id)
SELECT r.user_id, strftime(m, '%Y-%m-%d') AS missing_day FROM r LEFT JOIN d ON d.user_id = r.user_id AND d.day = CAST(m AS DATE)
WHERE d.day IS NULL AND isodow(m) < 6""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    gaps = calendar.weekday_gaps(user_days(spark, folder), ["user_id"], F.lit("2024-01-31").cast("date"))
    return gaps.select("user_id", _iso("missing_day"))


@job("artefact_gaps", """WITH d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
k AS (SELECT unnest(['view', 'click', 'signup', 'purchase', 'error']) AS kind)
SELECT user_id, strftime(day, '%Y-%m-%d') AS day, kind AS missing_kind FROM d, k
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = d.user_id AND CAST(e.ts AS DATE) = d.day AND e.event_type = k.kind)""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    gaps = calendar.missing_kinds(user_days(spark, folder), ["user_id", "day"], "event_type", KINDS)
    return gaps.select("user_id", _iso("day"), "missing_kind")


@job("provisional_days", """WITH s AS (SELECT user_id, CAST(ts AS DATE) AS day, bool_or(event_type = 'view') AS final FROM events GROUP BY ALL)
SELECT user_id, strftime(day, '%Y-%m-%d') AS day, 'journal-only' AS source_mode FROM s WHERE NOT final
AND EXISTS (SELECT 1 FROM events e WHERE e.user_id = s.user_id AND CAST(e.ts AS DATE) = s.day AND e.event_type = 'purchase')""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = user_days(spark, folder)
    mode = F.when(F.bool_or(F.col("event_type") == "view"), "new").otherwise("journal-only")
    stored = rows.groupBy("user_id", "day").agg(mode.alias("source_mode"))
    listed = rows.where(F.col("event_type") == "purchase")
    return calendar.provisional_days(stored, listed, ["user_id", "day"]).select("user_id", _iso("day"), "source_mode")


@job("trailing_windows", """WITH w AS (SELECT * FROM (VALUES ('1개월', 31), ('3개월', 92), ('6개월', 183), ('1년', 366), ('2년', 731), ('3년', 1096)) t(window_label, days)),
m AS (SELECT max(CAST(o_orderdate AS DATE)) AS latest FROM orders)
SELECT window_label, CAST(days AS BIGINT) AS window_days, o_orderstatus, count(*) AS n FROM orders, m, w
WHERE CAST(o_orderdate AS DATE) > latest - CAST(days AS INT) GROUP BY ALL""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    daily = orders.groupBy(F.col("o_orderdate").cast("date").alias("day"), "o_orderstatus").agg(F.count("*").alias("n"))
    out = calendar.trailing_windows(daily, ["o_orderstatus"], "n")
    return out.withColumn("window_days", F.col("window_days").cast("bigint"))


@job("mode_resolver", """WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS post, o_totalprice > 250000 AS gaps,
  CAST(substr(o_orderpriority, 1, 1) AS INT) AS clusters,
  CAST(o_orderdate AS DATE) + CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 ELSE -1 END AS listing FROM orders)
SELECT o_orderkey, CASE WHEN isodow(post) >= 6 AND NOT gaps THEN 'none' WHEN post = listing THEN 'new'
  WHEN post < listing THEN 'pastweek-date-section' WHEN clusters >= 3 THEN 'journal-only' ELSE 'none' END AS run_mode FROM o""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    post = F.col("o_orderdate").cast("date")
    shift = F.when(F.col("o_orderstatus") == "O", 0).when(F.col("o_orderstatus") == "F", 1).otherwise(-1)
    mode = calendar.run_mode(post, F.date_add(post, shift), F.substring("o_orderpriority", 1, 1).cast("int"),
                             F.col("o_totalprice") > 250000)
    return table(spark, folder, "orders").select("o_orderkey", mode.alias("run_mode"))


DAY = 86_400_000_000
define(POSTS="""posts AS (SELECT o_orderkey, o_custkey % 160 AS user_id, DATE '2023-12-28' + CAST(o_orderkey % 40 AS INT) AS post_day FROM orders)""")


def posts_of_users(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as posts of users in and around the days that the events have; some users have no event."""
    shift = F.date_add(F.lit("2023-12-28").cast("date"), (F.col("o_orderkey") % 40).cast("int"))
    return table(spark, folder, "orders").select("o_orderkey", (F.col("o_custkey") % 160).alias("user_id"), shift.alias("post_day"))


@job("asof_days", """WITH @POSTS@,
days AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL)
SELECT o_orderkey, p.user_id, strftime(post_day, '%Y-%m-%d') AS post_day, strftime(day, '%Y-%m-%d') AS last_day, n AS last_n
FROM posts p ASOF LEFT JOIN days d ON p.user_id = d.user_id AND p.post_day > d.day""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Each post with the last day strictly before it on which its user had events."""
    days = user_days(spark, folder).groupBy("user_id", "day").agg(F.count("*").alias("n"))
    found = asof_join(posts_of_users(spark, folder), days, ["user_id"], micros(F.col("post_day")), micros(F.col("day")), ["day", "n"], 7 * DAY)
    return found.select("o_orderkey", "user_id", _iso("post_day"), F.date_format("asof_day", "yyyy-MM-dd").alias("last_day"), F.col("asof_n").alias("last_n"))


@job("range_windows", """WITH @POSTS@
SELECT o_orderkey, count(*) AS n, count(*) FILTER (event_type = 'purchase') AS purchases FROM posts p
JOIN events e ON e.user_id = p.user_id AND e.ts >= p.post_day AND e.ts < p.post_day + (1 + CAST(o_orderkey % 9 AS INT)) * INTERVAL 1 DAY GROUP BY ALL""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """One window per post, of one to nine days: the events of its user in it."""
    length = (1 + F.col("o_orderkey") % 9) * F.lit(DAY)
    start = micros(F.col("post_day"))
    events = table(spark, folder, "events").select("user_id", "event_type", "ts")
    met = range_join(events, posts_of_users(spark, folder), micros(F.col("ts")), start, start + length, 4 * DAY, ["user_id"])
    return met.groupBy(F.col("window.o_orderkey").alias("o_orderkey")).agg(
        F.count("*").alias("n"), F.count_if(F.col("point.event_type") == "purchase").alias("purchases"))
