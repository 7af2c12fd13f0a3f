"""Small inputs for the tests."""

import random

RAW_TYPES = (
    "step bigint, type string, amount double, nameOrig string, oldbalanceOrg double, newbalanceOrig double, "
    "nameDest string, oldbalanceDest double, newbalanceDest double, isFraud int, isFlaggedFraud int")


def numbered(spark, rows, types):
    """A DataFrame whose row_id is the position in the list."""
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"row_id bigint, {types}")


def five_rows(spark):
    rows = [
        (1, "PAYMENT", 10.50, "C1001", 100.0, 89.5, "M1001", 0.0, 10.5, 0, 0),
        (2, "TRANSFER", 50000.0, "C1002", 60000.0, 10000.0, "C2001", 100.0, 50100.0, 1, 1),
        (2, "TRANSFER", 50000.0, "C1002", 60000.0, 10000.0, "C2001", 100.0, 50100.0, 1, 1),
        (3, "CASH_OUT", None, "C1003", 500.0, 500.0, "M1002", 0.0, 0.0, 0, 0),
        (25, "PAYMENT", 25.0, "C1004", 200.0, 175.0, "M1001", 0.0, 25.0, 0, 0),
    ]
    return numbered(spark, rows, RAW_TYPES)


def random_rows(seed, n, null_share=0.05, hot=0.35):
    """Raw rows with many ties; one user, one vendor and one copied row hold a third each."""
    rng = random.Random(seed)

    def maybe(value):
        return None if rng.random() < null_share else value

    rows = []
    for _ in range(n):
        user = "C0" if rng.random() < hot else f"C{rng.randrange(8)}"
        dest = "M0" if rng.random() < hot else f"{rng.choice('MC')}{rng.randrange(6)}"
        row = (
            rng.randrange(60), rng.choice(["PAYMENT", "TRANSFER"]), float(rng.choice([1, 2, 5, 5, 900])),
            maybe(user), float(rng.randrange(3)), 0.0, maybe(dest), 0.0, 0.0, rng.randrange(2), 0)
        rows.append((7, "PAYMENT", 5.0, "C0", 1.0, 0.0, "M0", 0.0, 0.0, 0, 0) if rng.random() < hot else row)
    rng.shuffle(rows)
    return rows


def random_raw(spark, seed=1, n=400, **kwargs):
    return numbered(spark, random_rows(seed, n, **kwargs), RAW_TYPES)


def as_dict(df, value, key="row_id"):
    return {r[key]: r[value] for r in df.select(key, value).collect()}
