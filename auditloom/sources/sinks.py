"""Writing result tables, and comparing what is read back."""

from pyspark.sql import functions as F

from auditloom.operators.skew import TASK_ROWS, task_count


def write_table(df, folder, name, formats=("parquet", "csv")):
    """Write the table once per format as <folder>/<name>.<format>."""
    for kind in formats:
        writer = df.write.mode("overwrite").format(kind)
        if kind == "csv":
            writer = writer.option("header", True)
            for side in ("Leading", "Trailing"):
                writer = writer.option(f"ignore{side}WhiteSpace", False)
        writer.save(f"{folder}/{name}.{kind}")


def read_table(spark, folder, name, schema, kind="parquet"):
    reader = spark.read.schema(schema).format(kind)
    if kind == "csv":
        reader = reader.option("header", True)
    return reader.load(f"{folder}/{name}.{kind}")


def common_rows(one, other, task_rows=TASK_ROWS):
    """The rows of ``one`` that ``other`` has too, as often as in the table with fewer of them (INTERSECT ALL).

    Rows of both go by their hash into tasks of about ``task_rows`` rows and are counted there; nothing is
    counted before, as few rows are alike. Copies of a row are many to a task, but one to a count.
    """
    tasks = task_count(one.sparkSession, 2 * one.count(), task_rows)
    if tasks is None:
        return one.intersectAll(other)
    columns = [F.col(f"`{c}`") for c in one.columns]
    here, there = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    rows = one.select(*columns, here.alias("_one"), there.alias("_other")).union(
        other.select(*columns, there.alias("_one"), here.alias("_other")))
    counts = rows.withColumn("_hash", F.xxhash64(*columns)).repartition(tasks, "_hash").groupBy("_hash", *columns).agg(
        F.least(F.sum("_one"), F.sum("_other")).alias("_times"))
    return counts.where("_times > 0").select(*columns, F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("col")
