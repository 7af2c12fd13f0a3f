import pytest
from pyspark.sql import functions as F

from auditloom.operators.clean import clean, normalize_category
from auditloom.operators.quality import audit_summary, column_profile
from auditloom.plans import warehouse
from auditloom.plans.pipeline import run_full_pipeline
from auditloom.plans.views import register_views, risk_color, slice_fact
from auditloom.plans.warehouse import save_tables
from auditloom.schema import RAW_COLUMNS
from auditloom.sources.sampling import number_by_id, sample_summary, shuffled, stratified_sample
from auditloom.sources.sinks import common_rows, write_table
from auditloom.sources.synthetic import generate_transactions
from auditloom.sources.transactions import UnreadableValues, load, load_all, staging
from tests.frames import five_rows, random_raw


def test_load_checks_columns_and_keeps_extras(spark, tmp_path):
    df = five_rows(spark).withColumn("note", F.lit("x")).drop("row_id")
    write_table(df.coalesce(1), str(tmp_path), "raw", ("csv",))
    back = load(spark, f"{tmp_path}/raw.csv")
    assert {"note", "row_id", *RAW_COLUMNS} == set(back.columns)
    assert [r.amount for r in back.orderBy("row_id").collect()] == [10.5, 50000.0, 50000.0, None, 25.0]
    write_table(df.drop("amount"), str(tmp_path), "bad", ("parquet",))
    with pytest.raises(ValueError, match="amount"):
        load(spark, f"{tmp_path}/bad.parquet")


def test_nan_is_missing(spark, tmp_path):
    df = five_rows(spark).withColumn("amount", F.coalesce("amount", F.lit(float("nan"))))
    write_table(df, str(tmp_path), "raw", ("parquet",))
    assert load(spark, f"{tmp_path}/raw.parquet").where("amount IS NULL").count() == 1


def test_staging_types(spark):
    types = dict(staging(five_rows(spark)).dtypes)
    assert types["amount"] == "decimal(18,2)" and types["step"] == "int" and types["type"] == "string"


@pytest.mark.parametrize("n_normal, chunk", [(50, 40), (10_000, 100), (100, 10**6)])
def test_sample_matches_brute_force(spark, n_normal, chunk):
    import hashlib
    raw = random_raw(spark, 9, 300)
    rows = raw.select("row_id", "isFraud").collect()
    order = lambda i: (hashlib.md5(f"{i}-42".encode()).hexdigest(), i)
    normal = {}
    for r in rows:
        if r.isFraud == 0:
            normal.setdefault(r.row_id // chunk, []).append(r.row_id)
    kept = sorted(
        (i for ids in normal.values() for i in sorted(ids, key=order)[:n_normal // 25]), key=order)[:n_normal]
    expected = sorted([r.row_id for r in rows if r.isFraud == 1] + kept)
    sample = stratified_sample(raw, n_normal, chunk_rows=chunk)
    assert sorted(r.row_id for r in sample.collect()) == expected
    assert sample_summary(sample).first().normal_records == len(kept)


def test_sample_does_not_depend_on_splits(spark):
    """Ids as a scan gives them: gaps of 2^33 between splits."""
    def sample(splits):
        rows = spark.range(20_000).select(
            F.col("id").alias("place"), F.when(F.col("id") % 100 == 0, 1).otherwise(0).alias("isFraud"))
        rows = rows.withColumn("row_id", F.expr(f"place + (place div {20_000 // splits}) * 8589934592"))
        return sorted(r.place for r in stratified_sample(rows, 1_000, chunk_rows=5_000).collect())

    assert sample(1) == sample(4) == sample(10) and len(sample(1)) == 200 + 160


@pytest.mark.parametrize("step", [1, 3, 100_000])
def test_numbers_by_id_have_no_gaps(spark, step):
    ids = [i * step + (1 << 33) * (i % 3) for i in range(3_000)] + [-5, -70_000]
    rows = spark.createDataFrame([(i,) for i in ids], "row_id bigint").repartition(5)
    found = {r.row_id: r["_number"] for r in number_by_id(rows).collect()}
    assert [found[i] for i in sorted(ids)] == list(range(len(ids)))


def test_dense_ids_are_numbered_without_a_shuffle_of_rows(spark, tmp_path):
    spark.range(300_000).select(F.col("id").alias("row_id")).write.parquet(f"{tmp_path}/ids")
    found = number_by_id(spark.read.parquet(f"{tmp_path}/ids"))
    assert found.where("_number <> row_id").isEmpty() and found.count() == 300_000
    plan = found._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan


def test_shuffled_order_is_one_order(spark):
    rows = random_raw(spark, 4, 200)
    orders = [[r.row_id for r in shuffled(rows.repartition(n)).orderBy("position").collect()] for n in (1, 6)]
    assert orders[0] == orders[1] != sorted(orders[0]) and sorted(orders[0]) == list(range(200))


def test_cap_of_the_sample(spark):
    raw = spark.range(20_000).select(
        F.col("id").alias("row_id"), F.when(F.col("id") % 100 == 0, 1).otherwise(0).alias("isFraud"))
    sample = sample_summary(stratified_sample(raw, 1_000, chunk_rows=100)).first()
    assert tuple(sample) == (1_200, 200, 1_000)


def test_synthetic_transactions(spark):
    df = generate_transactions(spark, 20_000).cache()
    assert df.count() == 20_000 + 30 + 35 + 40 + 40
    assert df.select("row_id").distinct().count() == df.count()
    plain = df.where("row_id < 20000")
    assert plain.where("amount IS NULL").count() in range(45, 51)
    assert plain.where("oldbalanceOrg IS NULL").count() == 30
    assert plain.where("amount >= 150000").count() == 25
    shares = {r.type: r.n / 20_000 for r in plain.groupBy("type").agg(F.count("*").alias("n")).collect()}
    for name, share in (("PAYMENT", 0.35), ("TRANSFER", 0.20), ("CASH_OUT", 0.25), ("DEBIT", 0.05), ("CASH_IN", 0.15)):
        assert abs(shares[name] - share) < 0.015
    mean = plain.where("type = 'PAYMENT' AND amount < 100000").agg(F.avg("amount")).first()[0]
    assert abs(mean - 37) < 2
    median = plain.where("type = 'TRANSFER'").agg(F.median("amount")).first()[0]
    assert abs(median / 1808 - 1) < 0.1
    steps = plain.agg(F.min("step"), F.max("step")).first()
    assert tuple(steps) == (1, 743)
    assert df.where("step = 250 AND oldbalanceOrg = 10000 AND newbalanceOrig = 8500").count() == 40
    again = generate_transactions(spark, 20_000).agg(F.sum(F.xxhash64(*RAW_COLUMNS).cast("decimal(38,0)"))).first()
    assert again == df.agg(F.sum(F.xxhash64(*RAW_COLUMNS).cast("decimal(38,0)"))).first()
    df.unpersist()


def test_full_pipeline_from_csv(spark, tmp_path):
    raw = generate_transactions(spark, 2_000).orderBy("row_id").drop("row_id")
    write_table(raw.coalesce(1), str(tmp_path), "raw", ("csv",))
    tables, summary, seconds = run_full_pipeline(f"{tmp_path}/raw.csv", str(tmp_path / "out"), database="audit_test")
    kept = raw.where("amount IS NOT NULL").count()
    assert summary.total_transactions == tables["fact_transactions"].count() == kept
    assert spark.table("audit_test.fact_transactions").count() == summary.total_transactions
    assert spark.table("audit_test.data_quality_summary").count() == 11
    for name in ("clean_transactions", "flagged_transactions", "fact_transactions", "dim_vendor", "dim_date"):
        assert (tmp_path / "out" / f"{name}.parquet").exists() and (tmp_path / "out" / f"{name}.csv").exists()
    ids = [r.transaction_id for r in tables["fact_transactions"].select("transaction_id").collect()]
    assert sorted(ids)[0] == "TXN_00000001" and len(set(ids)) == len(ids)
    register_views(tables)
    top = spark.sql("SELECT * FROM v_suspicious_transactions LIMIT 3").collect()
    assert top[0].anomaly_score >= top[2].anomaly_score
    assert spark.sql("SELECT SUM(total_txns) FROM v_daily_audit_trend").first()[0] == summary.total_transactions


def test_a_failed_replacement_leaves_the_old_warehouse(spark, ws, tmp_path, monkeypatch):
    tables, place = ws.tables(), str(tmp_path / "house")
    count = lambda name: spark.table(f"house.{name}").count()
    names = lambda: {t.name for t in spark.catalog.listTables("house") if not t.isTemporary}
    save_tables(tables, "house", place)
    assert names() == set(tables) and count("fact_transactions") == 1047
    few = {n: t.limit(5) for n, t in tables.items()}
    broken = few | {"dim_category": few["dim_category"].withColumn("category_id", F.raise_error(F.lit("lost")))}
    with pytest.raises(Exception, match="lost"):
        save_tables(broken, "house", place)
    assert names() == set(tables) and count("fact_transactions") == 1047
    assert count("dim_date") == tables["dim_date"].count() and len(list((tmp_path / "house" / "versions").iterdir())) == 1
    exchange, done = warehouse._rename, []

    def fails_late(*names):
        done.append(names)
        if len(done) == 6:
            raise RuntimeError("catalog lost")
        exchange(*names)

    monkeypatch.setattr(warehouse, "_rename", fails_late)
    with pytest.raises(RuntimeError):
        save_tables(few, "house", place)
    assert names() == set(tables) and count("fact_transactions") == 1047 and count("dim_vendor") > 5
    save_tables(few, "house", place)
    assert names() == set(tables) and all(count(n) <= 5 for n in tables)
    spark.sql("DROP DATABASE house CASCADE")


def test_audit_summary(spark, ws):
    profile = column_profile(five_rows(spark))
    assert audit_summary(profile, ws.flagged()).count() == 11
    assert audit_summary(None, ws.flagged()).first().records_evaluated == 1047


def test_slicers_and_colours(spark, ws):
    tables = ws.tables()
    assert slice_fact(tables).count() == 1047
    weekend = slice_fact(tables, weekend=True).count()
    assert weekend + slice_fact(tables, weekend=False).count() == 1047
    colors = {r[0]: r[1] for r in spark.createDataFrame([("HIGH",), ("x",)], "risk_level string").select(
        "risk_level", risk_color()).collect()}
    assert colors == {"HIGH": "#F57C00", "x": "#9E9E9E"}


HEADER = ",".join(RAW_COLUMNS)


def csv_file(tmp_path, *lines, header=HEADER):
    (tmp_path / "raw.csv").write_text("\n".join([header, *lines]) + "\n")
    return f"{tmp_path}/raw.csv"


def test_unreadable_values_are_rejected_and_never_missing(spark, tmp_path):
    path = csv_file(
        tmp_path,
        "1,PAYMENT,10.50,C1,100,89.5,M1,0,10.5,0,0",            # 0: plain
        '2,PAYMENT,"1,200.50",C1,100,89.5,M1,0,10.5,0,0',       # 1: separator of thousands
        "3,PAYMENT,$99.00,C1,100,89.5,M1,0,10.5,0,0",           # 2: currency
        "4.0,PAYMENT, 7e1 ,C1,100,89.5,M1,0,10.5,True,false",   # 3: whole number with a fraction, labels as words
        "5.5,PAYMENT,1,C1,100,89.5,M1,0,10.5,yes,0",            # 4: two columns
        "6,PAYMENT,NA,C1,nan,89.5,M1,0,10.5,0,0",               # 5: missing
        "7,PAYMENT,,C1,100,89.5,M1,0,10.5,0,0",                 # 6: missing
        "8,PAYMENT,1,C1,100,89.5,M1,0,10.5,0",                  # 7: too short
        "9,PAYMENT,1,C1,100,89.5,M1,0,10.5,0,0,0",              # 8: too long
        "10,PAYMENT,1d,C1,inf,89.5,M1,0,10.5,3000000000,0",     # 9: not numbers, out of range
        "11,PAYMENT,-.5,C1,100,89.5,M1,0,10.5,1,0")             # 10
    rows, rejects = load_all(spark, path)
    found = {r.row_id: r for r in rows.collect()}
    assert {i: (r.step, r.amount, r.isFraud) for i, r in found.items()} == {
        0: (1, 10.5, 0), 3: (4, 70.0, 1), 5: (6, None, 0), 6: (7, None, 0), 10: (11, -0.5, 1)}
    assert found[5].oldbalanceOrg is None
    bad = {r.row_id: r for r in rejects.collect()}
    assert {i: r.unreadable for i, r in bad.items()} == {
        1: ["amount"], 2: ["amount"], 4: ["step", "isFraud"], 7: ["line"], 8: ["line"],
        9: ["amount", "oldbalanceOrg", "isFraud"]}
    assert "1,200.50" in bad[1].content and "9,PAYMENT,1,C1" in bad[8].content
    assert clean(rows).count() + rows.where("amount IS NULL").count() + rejects.count() == 11


def test_a_limit_of_rejects_raises(spark, tmp_path):
    path = csv_file(tmp_path, "1,PAYMENT,x,C1,1,1,M1,0,0,0,0", "2,PAYMENT,5,C1,1,1,M1,0,0,0,0")
    with pytest.raises(UnreadableValues, match="amount: 1") as caught:
        load(spark, path)
    assert caught.value.rejects.count() == 1
    assert [r.amount for r in load(spark, path, max_rejects=1).collect()] == [5.0]
    with pytest.raises(UnreadableValues):
        run_full_pipeline(path, str(tmp_path / "out"))
    assert spark.read.parquet(f"{tmp_path}/out/rejected_rows.parquet").count() == 1


def test_typed_input_is_checked_too(spark, tmp_path):
    df = five_rows(spark).withColumns({
        "step": F.col("step") + F.when(F.col("row_id") == 4, 0.5).otherwise(0.0), "isFraud": F.col("isFraud") == 1,
        "amount": F.col("amount").cast("string")})
    write_table(df, str(tmp_path), "raw", ("parquet",))
    rows, rejects = load_all(spark, f"{tmp_path}/raw.parquet")
    assert [(r.row_id, r.isFraud, r.amount) for r in rows.orderBy("row_id").collect()] == [
        (0, 0, 10.5), (1, 1, 50000.0), (2, 1, 50000.0), (3, 0, None)]
    assert [(r.row_id, r.unreadable) for r in rejects.collect()] == [(4, ["step"])]
    write_table(five_rows(spark), str(tmp_path), "plain", ("parquet",))
    assert load_all(spark, f"{tmp_path}/plain.parquet")[1].count() == 0


@pytest.mark.parametrize("space", [" ", " ", "　", "\u0085", "\u001c", "\u001f", "\t", "\r\n", " "])
def test_categories_lose_every_kind_of_space(spark, space):
    df = five_rows(spark).withColumn("type", F.concat(F.lit(space), F.lit("a" + space + "b"), F.lit(space * 2)))
    assert {r.type for r in normalize_category(df).select("type").collect()} == {("a" + space + "b").upper()}


def test_common_rows_in_many_tasks_are_those_of_intersect_all(spark):
    rows = [(i % 40 if i % 3 else None, float("nan") if i % 5 == 0 else -0.0 if i % 5 == 1 else 1.5, f"t{i % 4}") for i in range(400)]
    one = spark.createDataFrame(rows, "row_id bigint, amount double, `a.b` string")
    other = spark.createDataFrame(
        [(r, 0.0 if a == 0 else a, t) for r, a, t in rows[::2]] + [(7, 9.0, "x")] * 3, one.schema)
    for a, b in ((one, other), (other, one)):
        many = common_rows(a, b, task_rows=10)
        assert many.rdd.getNumPartitions() >= 40
        assert sorted(map(str, many.collect())) == sorted(map(str, a.intersectAll(b).collect()))
