import datetime

import pytest
from pyspark.sql import functions as F

from wxpipe.__main__ import main, parser
from wxpipe.schemas import FACT_WEATHER, TRANSFORMED_WEATHER
from wxpipe.sinks import current, publish, recover, swap_all, swap_in
from wxpipe.sinks.jdbc import column_types
from wxpipe.sources import JdbcEndpoint, parquet_table
from wxpipe.sources.jdbc import split_predicates
from wxpipe.staging import Staging, shared_folder


def test_publish_and_refresh(spark, tmp_path):
    folder = str(tmp_path / "tables")
    publish(spark, {"a": spark.range(3), "b": spark.range(5)}, folder)
    publish(spark, {"a": spark.range(4)}, folder)
    assert parquet_table(spark, f"{folder}/a").count() == 4
    assert parquet_table(spark, f"{folder}/b").count() == 5
    assert sorted(p.name for p in (tmp_path / "tables").iterdir()) == ["a", "b"]


def test_failed_write_touches_no_table(spark, tmp_path):
    folder = str(tmp_path / "tables")
    publish(spark, {"a": spark.range(3)}, folder)
    broken = spark.range(2).selectExpr("raise_error('no') AS id")
    with pytest.raises(Exception, match="no"):
        publish(spark, {"a": spark.range(9), "b": broken}, folder)
    assert parquet_table(spark, f"{folder}/a").count() == 3
    assert sorted(p.name for p in (tmp_path / "tables").iterdir()) == ["a"]


def test_failed_swap_brings_the_old_table_back(spark, tmp_path):
    target = str(tmp_path / "t")
    spark.range(3).write.parquet(target)
    with pytest.raises(Exception):  # noqa: B017 - the file system decides which
        swap_in(spark, str(tmp_path / "absent"), target)
    assert parquet_table(spark, target).count() == 3


@pytest.mark.parametrize("bad", range(3))
def test_a_failed_swap_undoes_the_others(spark, tmp_path, bad):
    moves = {}
    for n in range(3):
        spark.range(n + 1).write.parquet(str(tmp_path / f"old{n}"))
        if n != bad:
            spark.range(10).write.parquet(str(tmp_path / f"new{n}"))
        moves[str(tmp_path / f"new{n}")] = str(tmp_path / f"old{n}")
    with pytest.raises(Exception):  # noqa: B017 - the file system decides which
        swap_all(spark, moves)
    assert [parquet_table(spark, str(tmp_path / f"old{n}")).count() for n in range(3)] == [1, 2, 3]


class Stopped(BaseException):
    """The process is gone: nothing runs after it, not even the undoing."""


def stop_at(monkeypatch, step):
    """Let the process die before its ``step``-th change of the file system."""
    from wxpipe.sinks import tables

    left = [step]

    def dying(real):
        def run(*args):
            if not left[0]:
                raise Stopped
            left[0] -= 1
            return real(*args)

        return run

    for name in ("move", "delete", "add_text"):
        monkeypatch.setattr(tables, name, dying(getattr(tables, name)))
    monkeypatch.setattr(tables, "_undo", lambda *_: None)


@pytest.mark.parametrize("step", range(9))
def test_a_swap_stopped_anywhere_shows_old_or_new(spark, tmp_path, monkeypatch, step):
    """Two tables of one swap: never one of each, during the stop and after the next refresh."""
    folder = tmp_path / "tables"
    old, new = {"a": 3, "b": 5}, {"a": 4, "b": 6}
    publish(spark, {n: spark.range(k) for n, k in old.items()}, str(folder))
    moves = {}
    for name, k in new.items():
        spark.range(k).write.parquet(str(tmp_path / f"new-{name}"))
        moves[str(tmp_path / f"new-{name}")] = str(folder / name)

    def read():
        return {n: parquet_table(spark, current(spark, str(folder / n))).count() for n in old}

    with monkeypatch.context() as patch:
        stop_at(patch, step)
        try:
            swap_all(spark, moves)
            finished = True
        except Stopped:
            finished = False
    assert finished == (step > 7)
    expected = new if step else old
    assert read() == expected
    assert recover(spark, moves.values()) == (0 < step < 8)
    assert read() == expected
    assert {n: parquet_table(spark, str(folder / n)).count() for n in old} == expected
    publish(spark, {"a": spark.range(1)}, str(folder))
    assert read() == {"a": 1, "b": expected["b"]}
    assert sorted(p.name for p in folder.iterdir()) == ["a", "b"]


@pytest.mark.parametrize("step", range(1, 5))
def test_a_move_that_fails_takes_all_back(spark, tmp_path, monkeypatch, step):
    from wxpipe.sinks import tables

    moves = {}
    for name in ("a", "b"):
        spark.range(2).write.parquet(str(tmp_path / f"old-{name}"))
        spark.range(7).write.parquet(str(tmp_path / f"new-{name}"))
        moves[str(tmp_path / f"new-{name}")] = str(tmp_path / f"old-{name}")
    calls, real = [], tables.move

    def failing(*args):
        calls.append(args)
        if len(calls) == step:
            raise OSError("no")
        real(*args)

    monkeypatch.setattr(tables, "move", failing)
    with pytest.raises(OSError, match="no"):
        swap_all(spark, moves)
    assert [parquet_table(spark, str(tmp_path / f"old-{n}")).count() for n in "ab"] == [2, 2]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["new-a", "new-b", "old-a", "old-b"]


def test_targets_of_a_swap_share_a_folder(spark, tmp_path):
    with pytest.raises(ValueError, match="share a folder"):
        swap_all(spark, {"/x/a": f"{tmp_path}/a/t", "/x/b": f"{tmp_path}/b/t"})


def test_small_files_appear_whole_and_once(spark, tmp_path):
    from wxpipe.storage import add_text, names_in, read_text

    path = f"{tmp_path}/1"
    assert add_text(spark, path, "first\u00e9")
    assert not add_text(spark, path, "second")
    assert read_text(spark, path) == "first\u00e9"
    assert names_in(spark, str(tmp_path)) == ["1"]
    assert names_in(spark, f"{tmp_path}/absent") == []


def test_shared_folder_comes_from_the_session(spark):
    folder = shared_folder(spark)
    assert spark.conf.get("spark.checkpoint.dir").rstrip("/") == folder
    assert Staging(spark).root.startswith(folder + "/_staged-")


def test_a_cluster_must_name_its_shared_folder():
    class Context:
        master = "spark://host:7077"
        getConf = dict  # noqa: N815 - Spark's name
        getCheckpointDir = staticmethod(lambda: None)  # noqa: N815

    class Session:
        sparkContext = Context()  # noqa: N815
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_staging_clears_itself(spark):
    with Staging(spark) as staging:
        out = staging.write(spark.range(3), "t")
        assert out.count() == 3
        path = staging.path("t")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_scan_prunes_and_pushes_down(spark, capsys):
    df = parquet_table(spark, "/root/testdata/sf0.001/orders.parquet")
    df.where("o_custkey = 5").select("o_orderkey").explain("formatted")
    plan = capsys.readouterr().out
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    assert "EqualTo(o_custkey,5)" in plan


def test_jdbc_options(monkeypatch):
    monkeypatch.setenv("WXPIPE_JDBC_URL", "jdbc:postgresql://db/weather")
    monkeypatch.setenv("WXPIPE_JDBC_USER", "u")
    monkeypatch.setenv("WXPIPE_JDBC_PASSWORD", "not shown")
    monkeypatch.delenv("WXPIPE_JDBC_DRIVER", raising=False)
    endpoint = JdbcEndpoint.from_env()
    assert endpoint.options() == {
        "url": "jdbc:postgresql://db/weather",
        "user": "u",
        "password": "not shown",
    }
    assert "not shown" not in repr(endpoint)
    monkeypatch.delenv("WXPIPE_JDBC_URL")
    with pytest.raises(KeyError, match="WXPIPE_JDBC_URL"):
        JdbcEndpoint.from_env()


def test_jdbc_types():
    assert column_types(TRANSFORMED_WEATHER) == (
        "city VARCHAR(100), wind_direction VARCHAR(100), precipitation VARCHAR(100)"
    )
    assert column_types(FACT_WEATHER) == ""


MOMENT = datetime.datetime(2031, 5, 3, 4, 10)


@pytest.mark.parametrize(
    "column, lower, upper, parts, null_parts, slice_by",
    [
        ("id", 1, 90, 4, 3, "hash(city)"),
        ("id", 1, 90, 4, 1, "hash(city)"),
        ("id", 1, 90, 4, 3, None),
        ("id", 1, 90, 7, 0, None),
        ("id", 5, 5, 4, 2, "id"),
        ("id", 1, 3, 64, 5, "length(city)"),
        ("x", 0.5, 44.5, 6, 2, "hash(city)"),
        ("day", MOMENT.date(), MOMENT.date() + datetime.timedelta(9), 4, 2, "hash(city)"),
        ("at", MOMENT, MOMENT + datetime.timedelta(days=1), 5, 2, "hash(city)"),
    ],
)
def test_split_predicates_hold_for_each_row_once(
    spark, column, lower, upper, parts, null_parts, slice_by
):
    """Also for rows outside the bounds, without a value, or without anything to slice by."""
    rows = [
        (
            None if i % 3 == 0 else i - 5,
            None if i % 3 == 0 else i / 2,
            None if i % 3 == 0 else MOMENT.date() + datetime.timedelta(i // 8 - 1),
            None if i % 3 == 0 else MOMENT + datetime.timedelta(hours=i - 9),
            None if i % 7 == 0 else f"c{i % 11}",
        )
        for i in range(120)
    ]
    table = spark.createDataFrame(rows, "id int, x double, day date, at timestamp, city string")
    conditions = split_predicates(column, lower, upper, parts, null_parts, slice_by)
    held = table.select(
        sum((F.coalesce(F.expr(f"({c})"), F.lit(False)).cast("int") for c in conditions), F.lit(0))
    )
    assert {r[0] for r in held.collect()} == {1}
    assert len(conditions) <= parts + max(null_parts, 0)


def test_split_predicates_share_the_rows():
    assert split_predicates("id", 0, 100, 4, 2, "h") == [
        "id < 25",
        "id >= 25 AND id < 50",
        "id >= 50 AND id < 75",
        "id >= 75",
        "id IS NULL AND COALESCE(ABS(MOD(h, 2)), 0) = 0",
        "id IS NULL AND COALESCE(ABS(MOD(h, 2)), 0) = 1",
    ]


def test_job_arguments():
    args = parser().parse_args(
        ["weather-table", "--servers", "h:9092", "--checkpoint", "/c", "--folder", "/raw"]
    )
    assert (args.topic, args.folder, args.every) == ("weather_data", "/raw", None)
    with pytest.raises(SystemExit):
        parser().parse_args(["sensor-table", "--servers", "h", "--checkpoint", "/c"])
    with pytest.raises(SystemExit):
        main(["weather-star", "--folder", "/raw"])
