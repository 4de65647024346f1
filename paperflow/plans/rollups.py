"""Counts over time, votes, grades, trends, comparisons with the previous day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rollup, sets
from ..sources.tables import table
from .calendars import _iso, user_days
from .catalog import job
from .standins import papers


def daily_type_counts(spark: SparkSession, folder: str) -> DataFrame:
    return user_days(spark, folder).groupBy("day", "event_type").agg(F.count("*").alias("n"))


def count_text(entries):
    """Map or entry array as sorted ``k:v`` pairs."""
    return F.array_join(F.transform(F.sort_array(entries), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))), " ")


def daily_maps(spark: SparkSession, folder: str) -> DataFrame:
    """One row per day with its counts as a map: a day holds one entry per event type."""
    pairs = F.collect_list(F.struct(F.col("event_type").alias("key"), F.col("n").alias("value")))
    return daily_type_counts(spark, folder).groupBy("day").agg(F.map_from_entries(pairs).alias("by_cat"))


@job("daily_counts", """WITH c AS (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL)
SELECT strftime(day, '%Y-%m-%d') AS day, CAST(sum(n) AS BIGINT) AS total, CASE WHEN isodow(day) = 1 THEN 'all' ELSE 'new+cross' END AS scope,
  strftime(day, '%a') AS weekday, string_agg(event_type || ':' || n, ' ' ORDER BY event_type) AS by_cat
FROM c WHERE isodow(day) < 6 GROUP BY day""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    trends = daily_maps(spark, folder).withColumn("scope", F.when(F.weekday("day") == 0, "all").otherwise(""))
    series = rollup.daily_series(trends)
    return series.select(_iso("day"), "total", "scope", "weekday", count_text(F.map_entries("by_cat")).alias("by_cat")).orderBy("day")


@job("new_counts", """WITH @PAPERS@ SELECT strftime(day, '%Y-%m-%d') AS day, primary_cat, count(*) AS n FROM papers
WHERE section IN ('new', 'cross') GROUP BY ALL""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.new_counts(papers(spark, folder), "day", "primary_cat").select(_iso("day"), "primary_cat", "n")


@job("weekly_rollup", """WITH e AS (SELECT CAST(ts AS DATE) AS day, event_type FROM events WHERE isodow(ts) < 6),
w AS (SELECT date_trunc('week', day) AS wk, event_type, count(*) AS n FROM e GROUP BY ALL),
d AS (SELECT date_trunc('week', day) AS wk, count(DISTINCT day) AS days_covered, count(*) AS week_total FROM e GROUP BY ALL)
SELECT strftime(w.wk, '%Y-%m-%d') AS week_start, event_type, n, days_covered, week_total FROM w JOIN d USING (wk)""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    weekly = rollup.weekly_rollup(daily_type_counts(spark, folder), "event_type")
    return weekly.select(_iso("week_start"), "event_type", "n", "days_covered", "week_total")


@job("listing_vote", """WITH s AS (SELECT user_id, event_type, max(CAST(ts AS DATE)) AS day FROM events GROUP BY ALL),
v AS (SELECT user_id, day, count(*) AS votes FROM s GROUP BY ALL)
SELECT user_id, strftime(day, '%Y-%m-%d') AS listing_date, votes AS agreeing, CAST(voting AS BIGINT) AS voting, (voting - votes) * 2 < voting AS publish FROM (
  SELECT *, sum(votes) OVER (PARTITION BY user_id) AS voting, row_number() OVER (PARTITION BY user_id ORDER BY votes DESC, day) AS r FROM v) WHERE r = 1""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    shown = user_days(spark, folder).groupBy("user_id", "event_type").agg(F.max("day").alias("day"))
    vote = rollup.listing_vote(shown, ["user_id"], "event_type", "day")
    return vote.select("user_id", _iso("listing_date"), "agreeing", "voting", "publish")


@job("label_scorecard", """SELECT CASE WHEN quality = 1 AND toxic = 0 THEN 'hit' WHEN quality = 1 THEN 'part' WHEN toxic = 0 THEN 'open' ELSE 'miss' END AS label,
  count(*) AS n FROM labels GROUP BY ALL""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    good, clean = F.col("quality") == 1, F.col("toxic") == 0
    label = F.when(good & clean, "hit").when(good, "part").when(clean, "open").otherwise("miss")
    return rollup.score_card(table(spark, folder, "labels").withColumn("label", label), "label")


@job("evidence_grade", """WITH g AS (SELECT conv_id, count(DISTINCT text) AS papers, count(DISTINCT role) AS author_groups FROM conversations GROUP BY ALL)
SELECT *, CASE WHEN papers >= 3 AND author_groups >= 2 THEN 'High' WHEN papers >= 2 THEN 'Medium' ELSE 'Low' END AS grade FROM g""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.evidence_grade(
        table(spark, folder, "conversations").select("conv_id", "role", F.md5("text").alias("text_md5")), ["conv_id"], "text_md5", "role")


@job("running_best", """WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, max(value) AS day_best FROM events WHERE value IS NOT NULL GROUP BY ALL)
SELECT event_type, strftime(day, '%Y-%m-%d') AS day, day_best,
  max(day_best) OVER (PARTITION BY event_type ORDER BY day ROWS UNBOUNDED PRECEDING) AS best FROM d""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    results = table(spark, folder, "events").select("event_type", F.col("ts").cast("date").alias("day"), "value")
    return rollup.running_best(results, ["event_type"], "day", "value").select("event_type", _iso("day"), "day_best", "best")


@job("hot_cold", """WITH c AS (SELECT date_trunc('week', ts) AS wk, event_type AS g, count(*) AS n FROM events GROUP BY ALL),
b AS (SELECT wk, g, n, 0 AS p FROM c UNION ALL SELECT wk + INTERVAL 7 DAY, g, 0, n FROM c WHERE wk < (SELECT max(wk) FROM c)),
s AS (SELECT wk, g, sum(n) AS n, sum(p) AS p FROM b GROUP BY ALL)
SELECT strftime(wk, '%Y-%m-%d') AS week_start, g AS event_type, CAST(n AS BIGINT) AS n, CAST(p AS BIGINT) AS prev_n, CAST(n - p AS BIGINT) AS delta,
  rank() OVER (PARTITION BY wk ORDER BY n - p DESC) AS heat_rank FROM s""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    weekly = user_days(spark, folder).groupBy(F.date_trunc("week", "day").cast("date").alias("week_start"), "event_type").agg(
        F.count("*").alias("n"))
    out = rollup.hot_cold(weekly, "event_type")
    return out.select(_iso("week_start"), "event_type", "n", "prev_n", "delta", "heat_rank")


_DAY_USERS = "du AS (SELECT DISTINCT CAST(ts AS DATE) AS day, user_id FROM events), dd AS (SELECT day, lag(day) OVER (ORDER BY day) AS prev FROM (SELECT DISTINCT day FROM du))"


@job("title_overlap", f"""WITH {_DAY_USERS}
SELECT strftime(d.day, '%Y-%m-%d') AS day, count(*) AS items, count(b.user_id) AS shared, count(b.user_id) < 4 AS fresh
FROM dd d JOIN du a USING (day) LEFT JOIN du b ON b.day = d.prev AND b.user_id = a.user_id GROUP BY d.day""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    overlap = sets.overlap_with_previous(user_days(spark, folder), [], "day", "user_id")
    return overlap.select(_iso("day"), "items", "shared", (F.col("shared") < 4).alias("fresh"))


@job("id_turnover", """WITH x AS (SELECT DISTINCT CAST(ts AS DATE) AS day, user_id AS title, props AS id FROM events),
dd AS (SELECT day, lag(day) OVER (ORDER BY day) AS prev FROM (SELECT DISTINCT day FROM x)),
t AS (SELECT day, title, count(*) AS ids FROM x GROUP BY ALL),
st AS (SELECT t.day, t.title, t.ids, d.prev FROM t JOIN dd d USING (day) JOIN t p ON p.day = d.prev AND p.title = t.title),
k AS (SELECT st.day, st.title, count(b.id) AS kept FROM st JOIN x a ON a.day = st.day AND a.title = st.title
  LEFT JOIN x b ON b.day = st.prev AND b.title = a.title AND b.id = a.id GROUP BY ALL)
SELECT strftime(st.day, '%Y-%m-%d') AS day, st.title, ids, ids - kept AS changed, count(*) OVER (PARTITION BY st.day) AS shared_titles,
  count(*) OVER (PARTITION BY st.day) < 4 AND (ids - kept) * 2 >= ids AS rename FROM st JOIN k ON k.day = st.day AND k.title = st.title""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select(
        F.col("ts").cast("date").alias("day"), F.col("user_id").alias("title"), F.col("props").alias("id"))
    return sets.turnover_under_title(rows, "day", "title", "id").withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@job("id_turnover_few", """WITH x AS (SELECT DISTINCT CAST(ts AS DATE) AS day, user_id % 3 AS title, CAST(json_extract(props, '$.k') AS BIGINT) % 9 AS id FROM events
  WHERE user_id < 5 + day(ts) % 7),
dd AS (SELECT day, lag(day) OVER (ORDER BY day) AS prev FROM (SELECT DISTINCT day FROM x)),
t AS (SELECT day, title, count(*) AS ids FROM x GROUP BY ALL),
st AS (SELECT t.day, t.title, t.ids, d.prev FROM t JOIN dd d USING (day) JOIN t p ON p.day = d.prev AND p.title = t.title),
k AS (SELECT st.day, st.title, count(b.id) AS kept FROM st JOIN x a ON a.day = st.day AND a.title = st.title
  LEFT JOIN x b ON b.day = st.prev AND b.title = a.title AND b.id = a.id GROUP BY ALL)
SELECT strftime(st.day, '%Y-%m-%d') AS day, st.title, ids, ids - kept AS changed, count(*) OVER (PARTITION BY st.day) AS shared_titles,
  count(*) OVER (PARTITION BY st.day) < 4 AND (ids - kept) * 2 >= ids AS rename FROM st JOIN k ON k.day = st.day AND k.title = st.title""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Few shared titles a day, so that renames occur."""
    rows = table(spark, folder, "events").where(F.col("user_id") < 5 + F.dayofmonth("ts") % 7).select(
        F.col("ts").cast("date").alias("day"), (F.col("user_id") % 3).alias("title"), (F.get_json_object("props", "$.k").cast("bigint") % 9).alias("id"))
    return sets.turnover_under_title(rows, "day", "title", "id").withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@job("identical_batch", """WITH c AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL),
f AS (SELECT user_id, day, string_agg(event_type || ':' || n, ' ' ORDER BY event_type) AS fp FROM c GROUP BY ALL),
i AS (SELECT user_id, CAST(ts AS DATE) AS day, string_agg(DISTINCT event_type, ' ' ORDER BY event_type) AS ids FROM events GROUP BY ALL),
j AS (SELECT f.user_id, f.day, fp, ids FROM f JOIN i USING (user_id, day)),
l AS (SELECT *, lag(fp) OVER w AS pf, lag(ids) OVER w AS pi FROM j WINDOW w AS (PARTITION BY user_id ORDER BY day))
SELECT user_id, strftime(day, '%Y-%m-%d') AS day, coalesce(fp = pf, false) AS same_counts, coalesce(ids = pi, false) AS same_ids,
  coalesce(fp = pf AND ids = pi, false) AS identical FROM l""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select(
        "user_id", F.col("ts").cast("date").alias("day"), "event_type", F.col("event_type").alias("id"))
    counts = rows.groupBy("user_id", "day", "event_type").agg(F.count("*").alias("n"))
    out = sets.identical_batches(counts, rows, ["user_id"], "day", "event_type", "n", "id")
    return out.withColumn("day", F.date_format("day", "yyyy-MM-dd"))
