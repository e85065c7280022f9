import importlib

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wxpipe import operators as ops


def test_drop_null_rows(spark):
    df = spark.createDataFrame(
        [(1, 1.0, ""), (2, float("nan"), "a"), (3, None, "a"), (None, 1.0, "a"), (4, 2.0, None)],
        "a int, b double, c string",
    )
    assert rows(ops.drop_null_rows(df)) == [(1, 1.0, "")]


def test_null_filter_reaches_the_scan(spark, staging, capsys):
    df = staging.write(spark.range(5).selectExpr("id", "id * 2.0D AS x"), "t")
    ops.drop_null_rows(df).select("x").explain("formatted")
    plan = capsys.readouterr().out
    assert "IsNotNull(id)" in plan.split("PushedFilters")[1].splitlines()[0]


def test_drop_duplicate_rows(spark):
    df = spark.createDataFrame(
        [(1, None), (1, None), (1, 0.0), (1, -0.0), (2, float("nan")), (2, float("nan"))],
        "a int, b double",
    )
    assert ops.drop_duplicate_rows(df).count() == 3


def test_one_row_held_by_a_third_of_the_table(spark):
    df = spark.range(30_000).selectExpr("IF(id % 3 = 0, -1L, id) AS id")
    assert ops.drop_duplicate_rows(df).count() == 20_001


def test_duplicate_columns_compare_across_number_types(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "1", 1), (2, 2.0, "2", 2), (3, 3.0, "3", 4)],
        "i int, d double, s string, l long",
    )
    profile = ops.profile_columns(df)
    assert profile.duplicate_of == {"d": "i"}
    assert ops.drop_duplicate_columns(df).columns == ["i", "s", "l"]


def test_boolean_equals_one_and_zero(spark):
    df = spark.createDataFrame([(True, 1.0), (False, 0.0)], "b boolean, d double")
    assert ops.drop_duplicate_columns(df).columns == ["b"]


def test_long_and_double_are_not_mixed_up_beyond_double_precision(spark):
    df = spark.createDataFrame(
        [(2**53 + 1, float(2**53), 2**53), (5, 5.0, 5)], "a long, b double, c long"
    )
    # 2**53 + 1 reads as 2**53 once it is a double: same signature, different value.
    assert ops.profile_columns(df).duplicate_of == {"c": "b"}


def test_longs_equal_as_doubles_only_are_not_constant(spark):
    df = spark.createDataFrame([(2**53, 1), (2**53 + 1, 2)], "a long, b long")
    assert ops.profile_columns(df).constant == frozenset()


def test_long_limit_does_not_wrap(spark):
    df = spark.createDataFrame([(2**63 - 1, float(2**63)), (1, 1.0)], "a long, b double")
    assert ops.profile_columns(df).duplicate_of == {}


def test_missing_values_are_alike(spark):
    df = spark.createDataFrame(
        [(None, float("nan")), (1, 1.0), (2, 2.0)], "i int, d double"
    )
    assert ops.profile_columns(df).duplicate_of == {"d": "i"}


def test_columns_that_differ_in_one_row(spark):
    df = spark.range(10_000).selectExpr("id AS a", "IF(id = 7777, 0, id) AS b", "id AS c")
    assert ops.profile_columns(df).duplicate_of == {"c": "a"}


def test_the_first_rows_settle_what_they_can(spark):
    """Every column is cleared by the first partition; the others would fail if read."""
    df = spark.range(0, 100_000, 1, 10).selectExpr(
        "id", "IF(id >= 50000, raise_error('read'), -id) AS b", "concat('x', id) AS c"
    )
    profile = ops.profile_columns(df)
    assert (profile.empty, profile.duplicate_of, profile.constant) == (False, {}, frozenset())


def test_late_differences_are_found(spark):
    """Equal and constant for many rows, but not to the end."""
    df = spark.range(0, 20_000, 1, 4).selectExpr(
        "id AS a",
        "IF(id = 19999, -1, id) AS b",
        "IF(id = 19998, 1, 0) AS flag",
        "IF(id = 19997, 1, 0) AS other",
        "0 AS zero",
        "id AS c",
        "IF(id = 19999, -1, id) AS d",
    )
    profile = ops.profile_columns(df)
    assert profile.duplicate_of == {"c": "a", "d": "b"}
    assert profile.constant == {"zero"}


def test_columns_with_the_same_values_in_another_order(spark):
    df = spark.range(1000).selectExpr("id AS a", "999 - id AS b")
    assert ops.profile_columns(df).duplicate_of == {}


def test_constant_columns(spark):
    df = spark.createDataFrame(
        [(1, "x", None, None, float("nan")), (2, "x", None, "y", 3.0)],
        "varies int, same string, empty int, one string, nan double",
    )
    assert ops.drop_constant_columns(df).columns == ["varies"]
    assert ops.drop_constant_columns(df, protect=["one"]).columns == ["varies", "one"]


def test_no_rows_keeps_the_schema(spark):
    df = spark.createDataFrame([], "a int, b int, c string")
    assert ops.clean(df).schema == df.schema


def test_no_columns(spark):
    df = spark.range(3).select()
    assert ops.drop_null_rows(df).count() == 3
    assert ops.drop_constant_columns(df).columns == []


def test_one_row_leaves_no_column(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    with pytest.raises(ops.NoColumnsLeft, match="constant or repeats"):
        ops.clean(df)
    assert ops.clean(df, protect=["b"]).columns == ["b"]


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, 1, "u"), (2, 2, "v")], "`a.b` int, `c``d` int, `e f` string")
    assert ops.clean(df).columns == ["a.b", "e f"]


def test_clean_order_matters(spark):
    # Only after the null row has gone are a and b equal, and s constant.
    df = spark.createDataFrame(
        [(1, 1, "s", 1.5), (2, 2, "s", 2.5), (3, 9, "t", None), (2, 2, "s", 2.5)],
        "a int, b int, s string, d double",
    )
    out = ops.clean(df)
    assert out.columns == ["a", "d"]
    assert rows(out) == [(1, 1.5), (2, 2.5)]


def scans(monkeypatch):
    """Counts the aggregates over all rows that a profile asks for."""
    clean = importlib.import_module("wxpipe.operators.clean")
    calls, real = [], clean._settle

    def counted(*args):
        calls.append(args)
        return real(*args)

    monkeypatch.setattr(clean, "_settle", counted)
    return calls


def test_a_profile_takes_the_probe_and_one_scan(spark, monkeypatch):
    """Constants, duplicates, late differences and duplicates of later columns, all at once."""
    calls = scans(monkeypatch)
    df = spark.range(3000).selectExpr(
        "id",
        "id AS again",
        "CAST(id AS DOUBLE) AS real",
        "IF(id = 2999, -1, id) AS late",
        "IF(id = 2999, -1, id) AS late_again",
        "1 AS one",
        "IF(id = 2998, 2, 1) AS nearly",
        "id % 7 AS other",
    )
    profile = ops.profile_columns(df)
    assert profile.duplicate_of == {"again": "id", "real": "id", "late_again": "late"}
    assert profile.constant == {"one"}
    assert len(calls) == 1
    assert not ops.profile_columns(df.select("id", "other")).duplicate_of
    assert len(calls) == 1


def test_only_a_large_group_in_doubt_is_scanned_again(spark, monkeypatch):
    calls = scans(monkeypatch)
    equal = [f"id AS e{n}" for n in range(10)]
    late = [f"IF(id = 2999, -1, id) AS l{n}" for n in range(3)]
    profile = ops.profile_columns(spark.range(3000).selectExpr(*equal, *late))
    assert profile.duplicate_of == {**{f"e{n}": "e0" for n in range(1, 10)}, "l1": "l0", "l2": "l0"}
    assert len(calls) == 2


def test_many_equal_columns(spark):
    names = [f"c{i}" for i in range(60)]
    df = spark.range(50).selectExpr("id", *[f"id % 2 AS {n}" for n in names])
    assert ops.drop_duplicate_columns(df).columns == ["id", "c0"]


CELL = {
    "i": st.one_of(st.none(), st.integers(0, 2)),
    "d": st.one_of(st.none(), st.sampled_from([0.0, 1.0, 1.5, 2.0, float("nan")])),
    "s": st.one_of(st.none(), st.sampled_from(["", "0", "1", "a"])),
}
FRAME = st.lists(
    st.fixed_dictionaries(
        {"i": CELL["i"], "d": CELL["d"], "s": CELL["s"], "j": CELL["i"], "t": CELL["s"]}
    ),
    min_size=1,
    max_size=8,
)


def plain_clean(records):
    """Names and rows that the definitions leave, over plain tuples; None without rows."""
    whole = []
    for record in records:
        row = tuple(record[name] for name in "idsjt")
        if not any(v is None or v != v for v in row) and row not in whole:
            whole.append(row)
    if not whole:
        return None
    names, taken = [], []
    for name, values in zip("idsjt", zip(*whole, strict=True), strict=True):
        if values not in taken:
            taken.append(values)
            names.append(name)
    varied = [(n, v) for n, v in zip(names, taken, strict=True) if len(set(v)) > 1]
    return [n for n, _ in varied], list(zip(*(v for _, v in varied), strict=True))


@settings(
    max_examples=25,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
    derandomize=True,
)
@given(FRAME)
def test_clean_agrees_with_plain_tuples(spark, records):
    df = spark.createDataFrame(
        [tuple(r[c] for c in "idsjt") for r in records],
        "i int, d double, s string, j int, t string",
    )
    expected = plain_clean(records)
    if expected is None:
        assert ops.clean(df).count() == 0
    elif not expected[0]:
        with pytest.raises(ops.NoColumnsLeft):
            ops.clean(df)
    else:
        out = ops.clean(df)
        assert out.columns == expected[0]
        assert rows(out) == sorted(expected[1], key=repr)


def test_oracle_sees_nan_as_missing():
    assert plain_clean([{"i": 1, "d": float("nan"), "s": "", "j": 1, "t": ""}]) is None
