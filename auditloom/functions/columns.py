"""Column expressions shared by the operators; all stay inside code generation."""

from pyspark.sql import functions as F

from auditloom.schema import BASE_TIMESTAMP


def half_even(value, digits):
    """Round to ``digits`` decimals, ties to even, on the binary value."""
    scale = float(10 ** digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def money(value):
    return value.cast("decimal(18,2)")


def money_sum(value):
    """Sum of amounts in exact decimals, so the order of addition cannot show."""
    return F.sum(money(value)).cast("double")


def ratio(part, whole):
    """part / whole, 0 where the whole is 0 or missing."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def strip(text):
    """Trim every kind of white space, beyond ASCII too, and the separators U+001C to U+001F."""
    return F.regexp_replace(text, r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+\z", "")


def title(text):
    """Upper-case the first letter of every run of letters, lower-case the others."""
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def zero_padded(number, width=8):
    """Left-pad with zeros; longer numbers keep all their digits."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def step_timestamp(step):
    base = F.lit(BASE_TIMESTAMP).cast("timestamp_ntz")
    return F.timestamp_add("HOUR", step, base)


def day_bucket(step):
    """Whole days since the base time, also right for negative steps."""
    return F.floor(step / F.lit(24)).cast("bigint")


def tiered(value, tiers, default):
    """Name of the first tier whose floor the value reaches; tiers run downwards."""
    out = F.lit(default)
    for floor, name in reversed(tiers):
        out = F.when(value >= floor, name).otherwise(out)
    return out


def all_present(*names):
    out = F.lit(True)
    for name in names:
        out = out & F.col(name).isNotNull()
    return out
