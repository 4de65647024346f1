"""Release checks over day documents derived from the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..operators.gates import Artefacts, banned_phrase_counts, release_gates, release_verdict
from ..operators.observed import OBSERVED, write_watched
from ..operators.rank import leaders
from ..operators.rollup import daily_series, whole_counts
from ..session import scratch_path
from ..sources.tables import table
from .calendars import KINDS
from .catalog import define, job, sql_markup


def day_documents(spark: SparkSession, folder: str, mixed: bool = False) -> Artefacts:
    """Every day of the event table as a set of artefacts, spoilt in one way or another by the last digit of its date.

    ``mixed`` spoils what is sound otherwise and mends the rest: days that end in 2 repeat the day before, the tenth has two clusters, the twentieth
    and the thirtieth select more than they scan, and a day may pass all rules.

    Users with four events or more on a day are that day's clusters, the ``k`` values
    its paper ids.  Weekends are journal-only, carry the listing date of the day before
    and are not in the series, so that each rule meets days that pass and days that fail.
    """
    events = table(spark, folder, "events").select(
        "event_type", "user_id", F.col("ts").cast("date").alias("day"), F.get_json_object("props", "$.k").alias("k"))
    if mixed:
        again = events.where(F.dayofmonth("day") % 10 == 1).withColumn("day", F.date_add("day", 1))
        events = events.where(F.dayofmonth("day") % 10 != 2).unionByName(again)
    weekend, digit = F.weekday("day") >= 5, F.dayofmonth("day") % 10
    iso = F.date_format("day", "yyyy-MM-dd")
    # one row per day; the artefacts below share its exchange
    facts = events.groupBy("day").agg(
        F.count("*").alias("total"), F.count_if(F.col("event_type").isin("purchase", "click")).alias("picked"),
        F.count_if(F.col("event_type") == "error").alias("errors"), F.count_if(F.col("event_type") == "view").alias("views"),
        *[F.count_if(F.col("event_type") == k).alias(f"n_{k}") for k in KINDS])
    by_cat = F.map_from_entries(F.filter(F.array(*[
        F.struct(F.lit(k).alias("key"), F.col(f"n_{k}").cast("string").alias("value")) for k in KINDS]), lambda e: e["value"] != "0"))
    by_cat = F.when(digit == 9, F.create_map().cast("map<string,string>")).when(
        digit == 8, F.map_concat(by_cat, F.create_map(F.lit("x"), F.lit('"7"')))).otherwise(by_cat)
    trends = facts.withColumn("by_cat", by_cat).select(
        "day", F.lit(True).alias("readable"), F.when(digit == 3, "1999-01-01").otherwise(iso).alias("doc_date"),
        F.date_format(F.when(weekend, F.date_sub("day", 1)).otherwise(F.col("day")), "yyyy-MM-dd").alias("listing_date"),
        F.when(weekend, "journal-only").when(F.lit(mixed) | (F.col("errors") > F.col("views")), "new").otherwise("weekly").alias("source_mode"),
        F.when(F.lit(mixed) | (F.col("total") % 2 == 0), V.RELEASE_SCOPE).otherwise(V.LISTING_SCOPE).alias("scope"),
        "by_cat", F.to_json("by_cat").alias("counts_object"),
        F.col("total").cast("string").alias("total_scanned"), F.when(F.lit(mixed) & F.dayofmonth("day").isin(20, 30), F.col("total") + 1).otherwise(
            F.col("picked")).cast("string").alias("selected"),
        F.col("total").alias("shown"), (F.col("total") - F.when(F.lit(mixed), 0).otherwise(F.col("errors") % 2)).alias("parsed"),
        F.when(F.lit(mixed), F.when(F.col("views") % 4 == 0, 12).otherwise(3)).otherwise(F.col("views")).alias("geometry_papers"), F.lit(0).alias("geometry_named"))
    per_user = events.groupBy("day", "user_id").agg(F.count("*").alias("papers")).where(F.col("papers") >= 4)
    # rules look at the order of the first six only; the rest need no position of their own
    order = [F.desc("papers"), F.asc("user_id")]
    first = leaders(per_user, "day", order, V.CHECKED_CLUSTERS).select("day", "user_id", F.col("rank").alias("_rank"))
    ranked = per_user.join(F.broadcast(first), ["day", "user_id"], "left")
    clusters = ranked.select(
        "day", (F.coalesce("_rank", F.lit(V.CHECKED_CLUSTERS + 1)) - 1).alias("pos"),
        F.when(digit == 5, "same").otherwise(F.concat(F.lit("user "), F.col("user_id").cast("string"))).alias("title"),
        F.when(digit == 6, F.lit(1)).otherwise(F.col("papers")).alias("papers"),
        F.when(digit == 7, "short").otherwise(F.expr("repeat('evidence ', cast(papers as int) * 2)")).alias("why"))
    if mixed:
        clusters = clusters.where((F.dayofmonth("day") != 10) | (F.col("pos") < 2))
    month = F.when(digit == 4, "0001").otherwise(F.date_format("day", "yyMM"))
    ids = events.select("day", F.concat(month, F.lit("."), F.col("k")).alias("id"))
    posts = facts.select("day", F.concat(
        F.lit("<h1>"), F.when(F.col("errors") % 3 == 0, F.lit("undated")).otherwise(iso), F.lit("</h1><table><th>Cluster</th><th>"),
        F.lit("대표 논문</th><th>왜 중요?</th></table>"), F.when(F.col("views") % 7 == 3 if mixed else F.col("views") % 5 == 0, F.lit("a batch of SLAM")).otherwise("")).alias("html"))
    series = daily_series(trends.withColumn("by_cat", whole_counts(F.col("by_cat"))))
    return Artefacts(
        posts=posts, trends=trends, insights=facts.select("day", F.lit(True).alias("readable")), clusters=clusters, ids=ids,
        benchmarks=facts.where(F.col("errors") % 10 != 0 if mixed else F.col("errors") < 70).select("day", F.lit(True).alias("readable")),
        feed=facts.where(F.col("day") > F.lit("2024-01-05")).select("day"), series=series.select("day", "by_cat"))


_RULES = {
    "G01_artefacts_exist": "errors < 70 AND day > DATE '2024-01-05'",
    "G02_json_readable": "errors < 70",
    "G03_date": "digit <> 3",
    "G04_listing_date": "NOT weekend",
    "G05_mode": "weekend OR errors > views",
    "G06_scope": "total % 2 = 0",
    "G07_counts_present": "digit <> 9",
    "G08_counts_whole": "digit <> 8",
    "G09_totals": "total >= picked",
    "G10_post_markers": "errors % 3 <> 0",
    "G11_feed_link": "day > DATE '2024-01-05'",
    "G12_enough_clusters": "titles >= 3",
    "G13_titles_unique": "digit <> 5 OR titles < 2",
    "G14_title_overlap": "shared_titles < 4",
    "G15_not_identical": "true",
    "G16_cluster_papers": "digit <> 6 OR titles = 0",
    "G17_cluster_why": "titles = 0 OR digit <> 7 AND sixth * 18 >= 80",
    "G18_enough_listed": "total >= 50 AND digit <> 9",
    "G19_selected_share": "picked >= total * 0.4",
    "G20_id_month": "digit <> 4",
    "G21_shown_is_parsed": "errors % 2 = 0",
    "G22_series_row": "NOT weekend AND digit <> 8",
    "G23_geometry_row": "views < 10 OR views % 5 = 0",
    "G24_no_banned_phrase": "views % 5 <> 0",
}
_rows = " UNION ALL ".join(f"SELECT day, '{name}' AS rule, {test} AS ok FROM x" for name, test in _RULES.items())


_DAYS = """e AS (SELECT CAST(ts AS DATE) AS day, event_type, user_id FROM events),
f AS (SELECT day, isodow(day) >= 6 AS weekend, count(*) AS total, count(*) FILTER (event_type IN ('purchase', 'click')) AS picked,
  count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (event_type = 'view') AS views FROM e GROUP BY day),
u AS (SELECT day, user_id, count(*) AS papers FROM e GROUP BY ALL HAVING count(*) >= 4),
c AS (SELECT day, count(*) AS titles, min(papers) FILTER (r <= 6) AS sixth FROM (
  SELECT *, row_number() OVER (PARTITION BY day ORDER BY papers DESC, user_id) AS r FROM u) GROUP BY day),
p AS (SELECT day, lag(day) OVER (ORDER BY day) AS prev FROM f),
t AS (SELECT DISTINCT day, CASE WHEN day(day) % 10 = 5 THEN 'same' ELSE 'user ' || user_id END AS title FROM u),
o AS (SELECT p.day, count(*) AS shared FROM p JOIN t a ON a.day = p.day JOIN t b ON b.day = p.prev AND b.title = a.title GROUP BY p.day),
x AS (SELECT f.*, day(f.day) % 10 AS digit, coalesce(titles, 0) AS titles, sixth, coalesce(shared, 0) AS shared_titles
  FROM f LEFT JOIN c USING (day) LEFT JOIN o USING (day))"""


@job("release_gates", f"WITH {_DAYS} SELECT strftime(day, '%Y-%m-%d') AS day, rule, ok FROM ({_rows})")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return release_gates(day_documents(spark, folder)).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@job("release_verdict", f"""WITH {_DAYS} SELECT strftime(day, '%Y-%m-%d') AS day,
  count(*) FILTER (NOT ok AND rule <> 'G19_selected_share') AS failures, count(*) FILTER (NOT ok AND rule = 'G19_selected_share') AS warnings,
  count(*) FILTER (NOT ok AND rule <> 'G19_selected_share') = 0 AS publish FROM ({_rows}) GROUP BY day""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return release_verdict(release_gates(day_documents(spark, folder))).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


_MIXED_RULES = _RULES | {
    "G01_artefacts_exist": "errors % 10 <> 0 AND day > DATE '2024-01-05'", "G02_json_readable": "errors % 10 <> 0",
    "G05_mode": "true", "G06_scope": "true", "G24_no_banned_phrase": "views % 7 <> 3", "G09_totals": "day(day) NOT IN (20, 30)", "G12_enough_clusters": "least(titles, keep) >= 3",
    "G13_titles_unique": "digit <> 5 OR titles < 2", "G14_title_overlap": "shared_titles < 4", "G15_not_identical": "digit <> 2",
    "G19_selected_share": "day(day) IN (20, 30) OR picked >= total * 0.4", "G21_shown_is_parsed": "true", "G23_geometry_row": "views % 4 <> 0 OR views % 7 = 3",
    "G17_cluster_why": "titles = 0 OR digit <> 7 AND CASE WHEN day(day) = 10 THEN second ELSE sixth END * 18 >= 80"}
_mixed_rows = " UNION ALL ".join(f"SELECT day, '{name}' AS rule, {test} AS ok FROM x" for name, test in _MIXED_RULES.items())
_MIXED_DAYS = """e AS (SELECT CAST(ts AS DATE) AS day, event_type, user_id FROM events WHERE day(ts) % 10 <> 2
  UNION ALL SELECT CAST(ts AS DATE) + 1, event_type, user_id FROM events WHERE day(ts) % 10 = 1),
f AS (SELECT day, isodow(day) >= 6 AS weekend, count(*) AS total, count(*) FILTER (event_type IN ('purchase', 'click')) AS picked,
  count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (event_type = 'view') AS views FROM e GROUP BY day),
r AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY papers DESC, user_id) AS r FROM (
  SELECT day, user_id, count(*) AS papers FROM e GROUP BY ALL HAVING count(*) >= 4)),
u AS (SELECT * FROM r WHERE day(day) <> 10 OR r <= 2),
c AS (SELECT day, count(*) AS titles, min(papers) FILTER (r <= 6) AS sixth, min(papers) FILTER (r <= 2) AS second FROM r GROUP BY day),
p AS (SELECT day, lag(day) OVER (ORDER BY day) AS prev FROM f),
t AS (SELECT DISTINCT day, CASE WHEN day(day) % 10 = 5 THEN 'same' ELSE 'user ' || user_id END AS title FROM u),
o AS (SELECT p.day, count(*) AS shared FROM p JOIN t a ON a.day = p.day JOIN t b ON b.day = p.prev AND b.title = a.title GROUP BY p.day),
x AS (SELECT f.*, day(f.day) % 10 AS digit, CASE WHEN day(f.day) = 10 THEN 2 ELSE 1000000 END AS keep, coalesce(titles, 0) AS titles, sixth, second,
  coalesce(shared, 0) AS shared_titles FROM f LEFT JOIN c USING (day) LEFT JOIN o USING (day))"""


@job("release_gates_mixed", f"WITH {_MIXED_DAYS} SELECT strftime(day, '%Y-%m-%d') AS day, rule, ok FROM ({_mixed_rows})")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """Days on which the rules on totals, clusters and identical days fail, too."""
    return release_gates(day_documents(spark, folder, mixed=True)).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@job("release_verdict_mixed", f"""WITH {_MIXED_DAYS} SELECT strftime(day, '%Y-%m-%d') AS day,
  count(*) FILTER (NOT ok AND rule <> 'G19_selected_share') AS failures, count(*) FILTER (NOT ok AND rule = 'G19_selected_share') AS warnings,
  count(*) FILTER (NOT ok AND rule <> 'G19_selected_share') = 0 AS publish FROM ({_mixed_rows}) GROUP BY day""")
def _(spark: SparkSession, folder: str) -> DataFrame:
    return release_verdict(release_gates(day_documents(spark, folder, mixed=True))).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


_observed = " UNION ALL ".join(f"SELECT day, '{name}' AS rule, {_RULES[name]} AS ok FROM x" for name in OBSERVED)


@job("observed_gates", f"WITH {_DAYS} SELECT strftime(day, '%Y-%m-%d') AS day, rule, ok FROM ({_observed})")
def _(spark: SparkSession, folder: str) -> DataFrame:
    """The rules that single rows decide, from metrics of the jobs that write the documents."""
    checks = write_watched(day_documents(spark, folder), scratch_path(spark, "watched-days"))
    return checks.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


PHRASES = ("tion", "batch", "des ", "sich")
define(DOC_PLAIN=sql_markup("text"))


@job("banned_phrases", "WITH p AS (SELECT @DOC_PLAIN@ AS t FROM documents) " + " UNION ALL ".join(
    f"SELECT '{p}' AS phrase, CAST(sum((length(t) - length(replace(t, '{p}', ''))) // {len(p)}) AS BIGINT) AS n FROM p"
    for p in PHRASES))
def _(spark: SparkSession, folder: str) -> DataFrame:
    return banned_phrase_counts(table(spark, folder, "documents").select("text"), PHRASES, "text")
