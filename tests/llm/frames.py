"""Small tables with the awkward rows every operator must take."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_df(spark, *rows, extra=False):
    """Documents from (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    if extra:  # names the operators use themselves
        for name in ("node", "component", "digest", "keys", "at", "rank", "score", "kept", "spans",
                     "toxic", "name", "key", "piece", "length", "need_id", "hub", "parts"):
            df = df.withColumn(name, df["source"])
    return df


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)
