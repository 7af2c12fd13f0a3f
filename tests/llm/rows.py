"""Small inputs that hold the awkward cases."""

from pyspark.sql import types as T

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

#: Names that operators use inside.
CLASHES = ["row", "digest", "key", "copy", "n", "doc", "fingerprint", "component", "score", "keep_id", "shuffle_key"]


def awkward_documents(spark):
    """Missing values in every column, empty and long texts, equal rows, ids and texts; clashing columns."""
    long_text = "lorem Ipsum dolor sit amet " * 20_000
    texts = [
        "One two three four", "one TWO three four", "one two three four five", None, "", "", None, "   \n\t ", "É é É",
        "x", "Password = 'hunter2000' and x", "mail a@b.c or +49 (170) 123-4567", long_text, long_text + "!",
        "one two three four", "ÉCOLE one", "école one", "a b a b", "tie", "tie"]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows += [(None, "tie", None, None, None), (None, None, None, None, None), (18, "tie", "en", "s0", 3), rows[0], rows[0]]
    frame = spark.createDataFrame(rows, DOCUMENTS)
    for name in CLASHES:
        frame = frame.selectExpr("*", f"'clash' AS `{name}`")
    return frame.repartition(3)


def empty_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


def ordered(values):
    return sorted(values, key=repr)
