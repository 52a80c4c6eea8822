"""Tables made from rows, and the text cases every operator must take."""

EDGE_TEXTS = [None, "", " \n\t ", "one", "one two", "\n\n\n", "é ü 漢字 🙂    x", "a\x00b �"]


def docs(spark, rows, extra=""):
    """`rows` of (doc_id, text[, lang, source, n_chars, ...]) as a documents table."""
    schema = "doc_id long, text string, lang string, source string, n_chars long" + extra
    width = len(schema.split(","))
    return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], schema).repartition(3)


def texts(spark, values):
    return docs(spark, list(enumerate(values)))
