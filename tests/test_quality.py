from conftest import rows

from wxpipe import operators as ops


def test_duplicate_keys(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "a"), (1, "b"), (2, "a"), (None, "a")], "k int, s string"
    )
    assert rows(ops.duplicate_keys(df, ["k"])) == sorted([(1, 3), (None, 1)], key=repr)
    assert rows(ops.duplicate_keys(df, ["k", "s"])) == sorted(
        [(1, "a", 2), (None, "a", 1)], key=repr
    )


def test_orphan_keys(spark):
    fact = spark.createDataFrame([(1,), (9,), (9,), (None,)], "fk int")
    dim = spark.createDataFrame([(1,), (2,)], "pk int")
    assert rows(ops.orphan_keys(fact, "fk", dim, "pk")) == [(9, 2)]


def test_preview_is_a_top_k(spark, capsys):
    df = spark.range(100).selectExpr("IF(id = 50, NULL, 99 - id) AS n")
    assert [r.n for r in ops.preview(df, 3, order=["n"]).collect()] == [0, 1, 2]
    ops.preview(df, 3, order=["n"]).explain()
    assert "TakeOrderedAndProject" in capsys.readouterr().out
    assert ops.preview(df, 3).count() == 3
    ops.preview(df, 3).explain()
    assert "TakeOrdered" not in capsys.readouterr().out


def test_observed_counts_during_the_write(spark, staging):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    watch = ops.observed(df, "load")
    staging.write(watch.frame, "t")
    assert watch.metrics() == ops.LoadMetrics(3, {"a": 1, "b": 2})
