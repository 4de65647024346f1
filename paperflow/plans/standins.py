"""Paper records derived from the driver's tables, in Spark and in SQL.

The tables hold no papers, so every document becomes one: exact copies of a text
share their id, the source number picks the kind of source, the language picks the
subjects.  Keywords come from the invented vocabulary of the texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.papers import source_badge, unified_key
from ..functions.text import once
from ..operators.classify import assign_bucket, paper_text
from ..operators.dedup import first_wins
from ..operators.listing import drop_replaced
from ..sources.tables import table
from .catalog import define

# The nine topics with keywords of the invented vocabulary; the last topic is the catch-all.
_WORDS = (
    ("ersh", "enré", "enbe", "ciónmi", "ndst", "edwh", "ater", "schung", "eaueau", "osta"),
    ("ansh", "ones", "étre", "erbe", "rara", "haing", "ster", "chung", "aiai", "queos"),
    ("onea", "hewh", "èque", "einbe", "asbo", "inat", "tist", "ungung", "quean", "doco", "enen", "orhe"),
    ("ining", "rend", "enach", "cira", "ndth", "atin", "geung", "menté", "ases", "uebo", "eand"),
    ("edin", "schch", "enan", "ciónbo", "aton", "verö", "eaure", "queta", "esea"),
    ("edtion", "einpf", "eauch", "ciónie", "ensh", "stver", "pation"),
    ("ntat", "gever", "leeux", "asos", "reon", "beer", "euxè", "tall", "unger"),
    ("anon", "lich ", "eauque", "adomente", "eror", "sich ", "elleon", "arción", "thhe", "bech", "mentvi", "menteado"),
    ("that ", "pour ", "para ", "thly", "onnt", " the ", "schzu", "üein", "rech", "arco", "hier", "tion "),
)
BUCKETS = tuple((name, words) for (name, _), words in zip(V.BUCKETS, _WORDS))
BUCKET_NAMES = [name for name, _ in BUCKETS]

SUBJECTS = {
    "en": "Machine Learning (cs.LG); Artificial Intelligence (cs.AI)",
    "de": "Computer Vision (cs.CV)",
    "fr": "Optimization (math.OC); Artificial Intelligence (cs.AI); Computer Vision (cs.CV)",
    "es": "Optics (physics.optics); Image and Video Processing (eess.IV)",
}
CATS = {"en": "cs.LG", "de": "cs.CV", "fr": "math.OC", "es": ""}


def _by_lang(values: dict[str, str]) -> Column:
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.col("lang")), F.lit(""))


def _without_texts(docs: DataFrame) -> DataFrame:
    sn = F.substring("source", 4, 10).cast("int")
    return docs.select(
        "doc_id", "lang", "n_chars", F.when(sn < 10, "").when(sn < 15, "crossref").otherwise("openalex").alias("source"),
        _by_lang(SUBJECTS).alias("subjects"), F.when(sn < 10, _by_lang(CATS)).otherwise("").alias("primary_cat"),
        F.expr("date_add(date'2024-01-01', cast(n_chars % 60 as int))").alias("day"))


def papers(spark: SparkSession, folder: str, texts: bool = True) -> DataFrame:
    """Every document as a paper.  ``texts=False`` leaves out all that comes from the text, which is then not read."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "n_chars", "source")
    if not texts:
        return _without_texts(docs)
    docs = once(docs, h=F.md5("text"), sn=F.substring("source", 4, 10).cast("int")).drop("source")
    first = F.substring("h", 1, 1)
    doi = F.when(F.col("sn") < 10, "").when(F.col("sn") < 15, F.concat(F.lit("10.5555/"), F.upper(F.substring("h", 1, 12)))
                                            ).otherwise(F.concat(F.lit("10.5555/"), F.substring("h", 1, 12)))
    staged = once(docs, doi=doi, title=F.substring_index("text", "\n", 1))
    has_url = (F.col("doi") != "") & ((F.col("sn") >= 15) | (F.substring("h", 13, 1) > "7"))
    return staged.select(
        "doc_id", "lang", "n_chars", "h",
        F.when(F.col("sn") < 10, "").when(F.col("sn") < 15, "crossref").otherwise("openalex").alias("source"),
        F.when(F.col("sn") < 10, F.concat(F.lit("2401."), F.substring("h", 1, 8))).otherwise("").alias("arxiv_id"),
        F.when(F.col("doi") != "", F.concat(F.lit("doi:"), F.col("doi"))).otherwise("").alias("id"),
        "doi",
        F.when(has_url, F.concat(F.lit("https://doi.org/"), F.col("doi"))).otherwise("").alias("url"),
        "title",
        F.expr("slice(split(title, ' '), 1, 1 + cast(n_chars % 3 as int))").alias("authors"),
        F.when(F.col("sn") < 10, "").otherwise(F.concat(F.lit("Journal of "), F.col("lang"))).alias("journal"),
        _by_lang(SUBJECTS).alias("subjects"),
        F.when(F.col("sn") < 10, _by_lang(CATS)).otherwise("").alias("primary_cat"),
        F.when(first == "0", "replace").when(first.isin("1", "2"), "cross").when(first == "3", F.lit(None))
        .otherwise("new").alias("section"),
        F.expr("substring(text, char_length(title) + 2)").alias("abstract"),
        F.expr("date_add(date'2024-01-01', cast(n_chars % 60 as int))").alias("day"),
        F.when(F.col("sn") < 10, F.floor(F.col("sn") / 2)).when(F.col("sn") < 15, 5).otherwise(6).cast("int").alias("source_rank"),
    ).withColumn("created", F.date_format("day", "yyyy-MM-dd"))


def unique_papers(spark: SparkSession, folder: str) -> DataFrame:
    key = unified_key(F.col("arxiv_id"), F.col("id"), F.col("doi"))
    return first_wins(drop_replaced(papers(spark, folder)), key, ["source_rank", "doc_id"])


def classified(spark: SparkSession, folder: str, title: bool = False) -> DataFrame:
    """The flagship job: drop replacements, assign bucket and badge, dedup.

    Bucket and badge depend on the row alone, so they come before the dedup and no abstract is shuffled.
    """
    text = paper_text(F.col("title"), F.col("abstract"), F.col("subjects"))
    out = assign_bucket(drop_replaced(papers(spark, folder)), text, BUCKETS)
    badge = source_badge(F.col("source"), F.col("primary_cat"), F.col("subjects")).alias("badge")
    key = unified_key(F.col("arxiv_id"), F.col("id"), F.col("doi")).alias("key")
    slim = out.select("doc_id", "n_chars", "source_rank", "bucket", badge, key, *["title"] * title)
    return first_wins(slim, F.col("key"), ["source_rank", "doc_id"])


def _sql_case(values: dict[str, str]) -> str:
    return "CASE lang " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " ELSE '' END"


def _sql_str(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_hits(text: str, buckets=BUCKETS) -> list[str]:
    return ["(" + " + ".join(f"contains({text}, {_sql_str(k)})::INT" for k in words) + ")" for _, words in buckets]


def sql_bucket(prefix: str = "hit", buckets=BUCKETS) -> str:
    cols = [f"{prefix}{i}" for i in range(len(buckets))]
    top = "greatest(" + ", ".join(cols) + ")"
    whens = " ".join(f"WHEN {c} = {top} THEN {_sql_str(name)}" for c, (name, _) in zip(cols, buckets))
    return f"CASE WHEN {top} = 0 THEN '' {whens} END"


define(
    PAPERS=f"""
docs AS (SELECT doc_id, text, lang, n_chars, md5(text) AS h, CAST(substr(source, 4) AS INT) AS sn FROM documents),
staged AS (
  SELECT *, split_part(text, chr(10), 1) AS title,
    CASE WHEN sn < 10 THEN '' WHEN sn < 15 THEN '10.5555/' || upper(substr(h, 1, 12)) ELSE '10.5555/' || substr(h, 1, 12) END AS doi
  FROM docs),
papers AS (
  SELECT doc_id, lang, n_chars, h,
    CASE WHEN sn < 10 THEN '' WHEN sn < 15 THEN 'crossref' ELSE 'openalex' END AS source,
    CASE WHEN sn < 10 THEN '2401.' || substr(h, 1, 8) ELSE '' END AS arxiv_id,
    CASE WHEN doi <> '' THEN 'doi:' || doi ELSE '' END AS id, doi,
    CASE WHEN doi <> '' AND (sn >= 15 OR substr(h, 13, 1) > '7') THEN 'https://doi.org/' || doi ELSE '' END AS url,
    title, list_slice(string_split(title, ' '), 1, 1 + n_chars % 3) AS authors,
    CASE WHEN sn < 10 THEN '' ELSE 'Journal of ' || lang END AS journal,
    {_sql_case(SUBJECTS)} AS subjects,
    CASE WHEN sn < 10 THEN {_sql_case(CATS)} ELSE '' END AS primary_cat,
    CASE WHEN h[1] = '0' THEN 'replace' WHEN h[1] IN ('1', '2') THEN 'cross' WHEN h[1] = '3' THEN NULL ELSE 'new' END AS section,
    substr(text, length(title) + 2) AS abstract,
    DATE '2024-01-01' + CAST(n_chars % 60 AS INT) AS day,
    strftime(DATE '2024-01-01' + CAST(n_chars % 60 AS INT), '%Y-%m-%d') AS created,
    CASE WHEN sn < 10 THEN sn // 2 WHEN sn < 15 THEN 5 ELSE 6 END AS source_rank
  FROM staged)""",
)
define(
    UNIQUE="""@PAPERS@,
keyed AS (
  SELECT *, CASE WHEN arxiv_id <> '' THEN arxiv_id ELSE lower(id) END AS key FROM papers
  WHERE coalesce(section, '') <> 'replace'),
unique_papers AS (
  SELECT * FROM keyed WHERE key <> ''
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY source_rank, doc_id) = 1)""",
)
_text = "lower(title || ' ' || abstract || ' ' || subjects)"
define(
    BADGE="""CASE WHEN source = 'crossref' THEN 'JNL' WHEN source = 'openalex' THEN 'OAX'
  WHEN primary_cat IN ('cs.LG','cs.CV','cs.AI','eess.IV','eess.SP') THEN
    CASE primary_cat WHEN 'cs.LG' THEN 'LG' WHEN 'cs.CV' THEN 'CV' WHEN 'cs.AI' THEN 'AI' WHEN 'eess.IV' THEN 'IV' ELSE 'SP' END
  WHEN contains(subjects, 'cs.LG') THEN 'LG' WHEN contains(subjects, 'cs.CV') THEN 'CV'
  WHEN contains(subjects, 'cs.AI') THEN 'AI' WHEN contains(subjects, 'eess.IV') THEN 'IV'
  WHEN contains(subjects, 'eess.SP') THEN 'SP'
  WHEN primary_cat <> '' THEN primary_cat ELSE '?' END""",
)
define(
    CLASSIFIED=f"""@UNIQUE@,
texts AS (SELECT *, {_text} AS t FROM unique_papers),
hits AS (SELECT *, {", ".join(f"{e} AS hit{i}" for i, e in enumerate(sql_hits("t")))} FROM texts),
classified AS (SELECT *, {sql_bucket()} AS bucket, @BADGE@ AS badge FROM hits)""",
    BUCKET_DIM="(VALUES " + ", ".join(f"({i}, {_sql_str(n)})" for i, n in enumerate(BUCKET_NAMES)) + ") AS dim(bucket_rank, bucket)",
)
define(
    SUMMARY="""@CLASSIFIED@,
counts AS (SELECT bucket, badge, count(*) AS n FROM classified WHERE bucket <> '' GROUP BY ALL),
summary AS (
  SELECT dim.bucket_rank, dim.bucket, CAST(coalesce(sum(n), 0) AS BIGINT) AS total,
    coalesce(string_agg(badge || ':' || n, ' ' ORDER BY badge), '') AS by_badge
  FROM @BUCKET_DIM@ LEFT JOIN counts USING (bucket) GROUP BY ALL)""",
)
