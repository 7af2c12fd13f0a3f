"""Reading raw transactions."""

from pyspark.sql import functions as F

from auditloom.schema import RAW_COLUMNS, RAW_SCHEMA
from auditloom.storage import spread_small, staged

LINE = "_line"
_FAILED, _CONTENT = "_failed", "_content"

# Texts that stand for a missing value in a CSV file.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null"]

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
WHOLE = r"^[+-]?[0-9]+(\.0*)?$"


def check_columns(df):
    missing = set(RAW_COLUMNS) - set(df.columns)
    if missing:
        raise ValueError(f"Input is missing expected transaction columns: {sorted(missing)}")
    return df


def with_row_id(df):
    """Add the ingest order as row_id unless the data brings its own.

    Numbers given by a scan depend on its splits, so they are written once and then read.
    """
    if "row_id" in df.columns:
        return df
    return staged(spread_small(df.withColumn("row_id", F.monotonically_increasing_id())), "raw")


def scan(spark, path):
    """Scan parquet or, for any other name, CSV with a header.

    CSV columns are text, as no value may be lost to a type it does not fit; a line with more or fewer
    fields than the header is kept whole in the column ``_line``, which is missing for other lines.
    """
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    names = spark.read.option("header", True).csv(path).columns
    schema = ", ".join(f"`{n}` string" for n in [*names, LINE])
    return spark.read.option("header", True).option("columnNameOfCorruptRecord", LINE).schema(schema).csv(path)


def _typed(name, source, target):
    """The value of a column in the type ``target``, and whether there is a value that has none in it.

    Text is a number if it is written as one, without separators of thousands or signs of currency; a whole
    number may have a fraction of zeros, and a label may be true or false. Texts that stand for a
    missing value, and NaN, are missing.
    """
    column = F.col(f"`{name}`")
    text = F.trim(column.cast("string"))
    if source == "string":
        column = F.when(~F.coalesce(text, F.lit("")).isin(*MISSING_TEXTS), column)
        text = F.trim(column)
    if target == "string":
        return column.cast("string"), None
    if target == "double":
        if source == "string":
            value = F.when(text.rlike(NUMBER), text.try_cast("double"))
            value = F.when(F.abs(value) < float("inf"), value)
            return value, column.isNotNull() & value.isNull()
        return F.nanvl(column.cast("double"), F.lit(None)), None
    if source in ("tinyint", "smallint", "int", target):
        return column.cast(target), None
    if source == "boolean":
        return column.cast("int").cast(target), None
    if source == "string":
        whole = F.when(text.rlike(WHOLE), F.regexp_replace(text, r"\..*", "")).otherwise(
            F.when(F.lower(text) == "true", "1").when(F.lower(text) == "false", "0") if target == "int" else None)
        value = whole.try_cast(target)
        return value, column.isNotNull() & value.isNull()
    if source in ("double", "float"):
        column = F.nanvl(column.cast("double"), F.lit(None))
    value = F.when(column == F.floor(column), column.cast("decimal(38,0)").try_cast(target))
    return value, column.isNotNull() & value.isNull()


def load_all(spark, path):
    """(rows, rejects): the rows in the raw types, and those with a value that has none in its type.

    Every row of the input is in one of the two, under a row_id that counts both, so nothing is lost and
    nothing that is there counts as missing. Rejects carry ``unreadable``, the names of the columns (or
    ``line`` for a line that does not fit the header), and ``content``, the row's raw columns as JSON.
    """
    df = check_columns(scan(spark, path))
    sources = dict(df.dtypes)
    types = {f.name: f.dataType.simpleString() for f in RAW_SCHEMA} | ({"row_id": "bigint"} if "row_id" in sources else {})
    typed = {c: _typed(c, sources[c], t) for c, t in types.items()}
    bad = {c: failed for c, (_, failed) in typed.items() if failed is not None}
    if LINE in sources:
        bad["line"] = F.col(LINE).isNotNull()
    if not bad:
        rows = with_row_id(df.withColumns({c: value for c, (value, _) in typed.items()}))
        none = rows.where(F.lit(False)).select(
            "row_id", F.array().cast("array<string>").alias("unreadable"), F.lit(None).cast("string").alias("content"))
        return rows, none
    failed = F.filter(F.array(*[F.when(f, F.lit(c)) for c, f in bad.items()]), lambda c: c.isNotNull())
    kept = [c for c in df.columns if c != LINE]
    content = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    df = df.withColumns({_FAILED: failed, _CONTENT: content})
    df = df.select(*[typed[c][0].alias(c) if c in typed else F.col(f"`{c}`") for c in kept], _FAILED,
                   F.when(F.size(_FAILED) > 0, F.col(_CONTENT)).alias(_CONTENT))
    if "row_id" not in kept:
        df = df.withColumn("row_id", F.monotonically_increasing_id())
    # numbers given by a scan depend on its splits, so they are written once and then read
    df = staged(spread_small(df), "raw")
    good = F.size(_FAILED) == 0
    return df.where(good).drop(_FAILED, _CONTENT), df.where(~good).select(
        "row_id", F.col(_FAILED).alias("unreadable"), F.col(_CONTENT).alias("content"))


class UnreadableValues(ValueError):
    """More rows than allowed have values that do not fit their columns' types; ``rejects`` holds them."""

    def __init__(self, rejects, counts, limit):
        found = ", ".join(f"{c}: {n}" for c, n in sorted(counts.items()))
        super().__init__(f"Unreadable values in more than {limit} rows (rows by column: {found})")
        self.rejects = rejects


def check_rejects(rejects, limit=0):
    """Raise if there are more than ``limit`` rejects; the message counts them by column."""
    if rejects.count() > limit:
        counts = rejects.select(F.explode("unreadable").alias("c")).groupBy("c").count().collect()   # a row per column
        raise UnreadableValues(rejects, {r.c: r["count"] for r in counts}, limit)
    return rejects


def load(spark, path, max_rejects=0):
    """The rows of ``load_all`` if it rejects no more than ``max_rejects``; else an error that names the columns."""
    rows, rejects = load_all(spark, path)
    check_rejects(rejects, max_rejects)
    return rows


def staging(df):
    """The typed staging table: decimals for money, 32-bit integers for counters."""
    as_type = {"bigint": "int", "int": "int", "double": "decimal(18,2)", "string": "string"}
    return df.select("row_id", *[
        F.col(f.name).cast(as_type[f.dataType.simpleString()]).alias(f.name) for f in RAW_SCHEMA])
