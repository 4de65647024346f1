"""Small tables for the corpus tests."""

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, schema=DOC):
    """``rows``: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, schema)


def sf_docs(spark, sf="0.001"):
    return spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")
