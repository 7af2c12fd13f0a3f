import os

from auditloom.storage import NARROW_ROWS, few_tasks, new_path, remove, scope, staged


def files(path):
    return os.path.isdir(path) and bool(os.listdir(path))


def test_scope_gathers_tables_and_leaves_others(spark):
    outside = staged(spark.range(3), "outside")
    with scope(spark, "outer") as outer:
        first = staged(spark.range(5), "first")
        with scope(spark, "inner") as inner:
            assert new_path(spark, "x").startswith(inner + "/")
            second = staged(spark.range(7), "second")
        assert new_path(spark, "x").startswith(outer + "/") and inner.startswith(outer + "/")
    assert not new_path(spark, "x").startswith(outer + "/")
    assert (first.count(), second.count()) == (5, 7)
    remove(spark, inner)
    assert first.count() == 5 and not files(inner)
    remove(spark, outer)
    assert outside.count() == 3 and not files(outer)


def test_scope_ends_with_an_error(spark):
    try:
        with scope(spark, "broken") as path:
            raise KeyError
    except KeyError:
        pass
    assert not new_path(spark, "x").startswith(path + "/")


def test_few_tasks_follow_the_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 600, 1, 60)
    assert few_tasks(rows, 600).rdd.getNumPartitions() == cores
    assert few_tasks(rows, 30 * NARROW_ROWS).rdd.getNumPartitions() == 30
    assert few_tasks(rows, 900 * NARROW_ROWS).rdd.getNumPartitions() == 60   # no more than there are
    assert few_tasks(rows, 600).count() == 600
