import datetime
from collections import Counter
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from wxpipe import operators as ops
from wxpipe.operators.star import BROADCAST_BYTES, attribute_members
from wxpipe.plans import load_star, star_frames
from wxpipe.schemas import (
    WEATHER_MESSAGE,
    WEATHER_STAR,
    DimensionSpec,
    StarSpec,
    TableContract,
)
from wxpipe.staging import Staging, shared_folder

MOMENT = datetime.datetime(2024, 1, 1, 6)
CITIES = ["osto", "vell", "brae"]
WINDS = ["east", "west"]


def raw_weather(spark, n=60, city=lambda i: CITIES[i % 3]):
    return spark.createDataFrame(
        [
            (
                i,
                MOMENT + datetime.timedelta(hours=i),
                city(i),
                20.0 + i,
                60.0 + i * 2,
                1000.0 + i * 3,
                i / 8,
                WINDS[i % 2],
                ["dew", "fog", "clear", "rain"][i % 4],
                float(i % 7),
            )
            for i in range(n)
        ],
        WEATHER_MESSAGE,
    )


@pytest.fixture(params=["merged", "sliced"])
def slices(spark, request):
    """Numbering with its members in one slice and in several."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, str(request.param == "merged").lower())
    yield request.param
    spark.conf.unset(key)


@pytest.mark.parametrize("partitions", [1, 3, 13])
def test_keys_do_not_depend_on_partitioning(spark, staging, partitions):
    df = spark.createDataFrame(
        [("a", f"v{i:03}") for i in range(100)] + [("b", None), ("b", "z"), ("b", "")],
        "slot string, member string",
    )
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = ops.number_within(df.repartition(7), "slot", "member", "key", staging)
        got = {(r.slot, r.member): r.key for r in out.collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert [got["a", f"v{i:03}"] for i in range(100)] == list(range(1, 101))
    assert (got["b", ""], got["b", "z"], got["b", None]) == (1, 2, 3)


@pytest.mark.parametrize("groups", [None, 500])
def test_many_groups(spark, staging, slices, groups):
    df = spark.range(2000).selectExpr("id % 500 AS slot", "format_string('%05d', id) AS member")
    out = ops.number_within(df, "slot", "member", "key", staging, groups=groups)
    got = {(r.slot, r.member): r.key for r in out.collect()}
    assert got == {(i % 500, f"{i:05}"): i // 500 + 1 for i in range(2000)}


def test_numbering_uses_many_tasks(spark, staging):
    """The window runs over slice counts; no task sees all values."""
    df = spark.range(1000).selectExpr("'s' AS slot", "cast(id AS string) AS member")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        ops.number_within(df, "slot", "member", "key", staging, "n").count()
    finally:
        spark.conf.unset(key)
    stored = spark.read.parquet(staging.path("n"))
    assert stored.select(F.shiftright("__mark", 33)).distinct().count() > 1


def test_members_are_counted_in_one_scan(spark):
    df = spark.createDataFrame([("x", "p"), ("x", None), ("y", "p")], "a string, b string")
    assert rows(attribute_members(df, ["a", "b"])) == sorted(
        [(0, "x", 2), (0, "y", 1), (1, "p", 2), (1, None, 1)], key=repr
    )


def dimension(spark, staging, values, name="d"):
    df = spark.createDataFrame([(v,) for v in values], "city string")
    spec = DimensionSpec("dim_city", "city", "city_id")
    return ops.build_dimensions(df, [spec], staging, name)["dim_city"]


def test_dimensions_in_one_slice_or_many(spark, staging, slices):
    df = spark.range(300).selectExpr(
        "format_string('c%03d', id) AS a",
        "IF(id % 7 = 0, NULL, format_string('%02d', id % 20)) AS b",
    )
    specs = [DimensionSpec("da", "a", "a_id"), DimensionSpec("db", "b", "b_id")]
    built = ops.build_dimensions(df, specs, staging, "d")
    marks = spark.read.parquet(staging.path("d-0-ranged"))
    assert (marks.select(F.shiftright("__mark", 33)).distinct().count() == 1) == (
        slices == "merged"
    )
    got = {r.a: r.a_id for r in built["da"].frame.collect()}
    assert got == {f"c{i:03}": i + 1 for i in range(300)}
    got = {r.b: r.b_id for r in built["db"].frame.collect()}
    assert got == {**{f"{i:02}": i + 1 for i in range(20)}, None: 21}
    assert (built["da"].rows, built["db"].rows) == (300, 21)


def test_dimension_sizes(spark, staging, slices):
    d = dimension(spark, staging, ["aa", "aa", "b", None])
    assert (d.rows, d.fact_rows, d.n_bytes) == (3, 4, 3 + 3 * 64)
    assert rows(d.frame) == [(1, "aa"), (2, "b"), (3, None)]
    assert d.frame.schema["city_id"].dataType.simpleString() == "int"


def test_attributes_of_different_types(spark, staging):
    df = spark.createDataFrame([("x", 10), ("y", 9), ("y", 10)], "name string, code int")
    specs = [DimensionSpec("dn", "name", "name_id"), DimensionSpec("dc", "code", "code_id")]
    built = ops.build_dimensions(df, specs, staging)
    assert list(built) == ["dn", "dc"]
    assert rows(built["dn"].frame) == [(1, "x"), (2, "y")]
    assert rows(built["dc"].frame) == [(1, 9), (2, 10)]


def test_empty_dimension(spark, staging):
    d = dimension(spark, staging, [])
    assert (d.rows, d.frame.count()) == (0, 0)


def test_large_dimension_is_not_broadcast(spark, staging, capsys):
    d = dimension(spark, staging, ["a", "b"])
    fact = spark.createDataFrame([(1, "a")], "id int, city string")
    ops.lookup_join(fact, d).explain()
    assert "BroadcastHashJoin [city" in capsys.readouterr().out
    ops.lookup_join(fact, d, broadcast_bytes=0).explain()
    assert "SortMergeJoin [city" in capsys.readouterr().out
    assert d.fits_broadcast(BROADCAST_BYTES) and not d.fits_broadcast(10)


@pytest.mark.parametrize("broadcast_bytes", [BROADCAST_BYTES, 0])
def test_lookup_with_a_hot_key_and_nulls(spark, staging, broadcast_bytes):
    values = ["hot"] * 3000 + [f"c{i % 500}" for i in range(5000)] + [None] * 1000
    d = dimension(spark, staging, values)
    fact = spark.createDataFrame(
        [(i, v) for i, v in enumerate(values)] + [(-1, "unknown")], "id int, city string"
    )
    out = ops.lookup_join(fact, d, broadcast_bytes, rows_per_task=100)
    keys = {r.city: r.city_id for r in d.frame.collect()}
    expected = Counter((i, v, keys[v]) for i, v in enumerate(values) if v is not None)
    assert Counter((r.id, r.city, r.city_id) for r in out.collect()) == expected


def test_hot_key_is_spread(spark, staging):
    values = ["hot"] * 3000 + ["cold"] * 10
    d = dimension(spark, staging, values)
    fact = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, city string")
    key = "spark.sql.adaptive.enabled"
    spark.conf.set(key, "false")
    try:
        out = ops.lookup_join(fact, d, broadcast_bytes=0, rows_per_task=100)
        tasks = out.where("city = 'hot'").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.set(key, "true")
    assert tasks > 1


@pytest.mark.parametrize("broadcast_bytes", [BROADCAST_BYTES, 0])
def test_rounding_merges_fact_rows(spark, staging, broadcast_bytes):
    raw = raw_weather(spark)
    near = raw.withColumn("temperature", F.col("temperature") + 0.001)
    cleaned, dimensions, _ = star_frames(raw.unionByName(near).unionByName(raw), staging)
    assert cleaned.count() == 120
    fact = ops.build_fact(cleaned, WEATHER_STAR, dimensions, broadcast_bytes, 10)
    assert fact.schema.simpleString() == WEATHER_STAR.fact.struct().simpleString()
    assert fact.count() == 60


def shuffles(df, capsys):
    df.explain()
    return capsys.readouterr().out.count("Exchange hashpartitioning")


def test_fact_is_not_shuffled_if_storing_changed_nothing(spark, staging, capsys):
    raw = raw_weather(spark).withColumn("wind_speed", F.col("wind_speed") * 8)
    raw = staging.write(raw.unionByName(raw), "raw")
    _, _, fact = star_frames(raw, staging)
    assert shuffles(fact, capsys) == 0
    assert fact.count() == fact.distinct().count() == 60


def test_one_changed_value_brings_the_comparison_back(spark, staging, capsys):
    raw = raw_weather(spark).withColumn("wind_speed", F.col("wind_speed") * 8)
    near = raw.where("id = 5").withColumn("humidity", F.col("humidity") + 0.001)
    raw = staging.write(raw.unionByName(near), "raw")
    cleaned, _, fact = star_frames(raw, staging)
    assert cleaned.count() == 61
    assert shuffles(fact, capsys) == 1
    assert fact.count() == 60


def test_fact_without_some_column_is_compared(spark, staging, capsys):
    columns = tuple(c for c in WEATHER_STAR.fact.columns if c.name not in ("id", "date_time"))
    star = StarSpec(
        WEATHER_STAR.cleaned, TableContract("fact", columns), WEATHER_STAR.dimensions
    )
    same = raw_weather(spark, 7 * 24).withColumns(
        {n: F.col("id") % 4 + F.lit(0.0) for n in ("temperature", "pressure", "humidity")}
    )
    same = same.withColumn("wind_speed", F.col("pressure"))
    raw = staging.write(same, "raw")
    _, _, fact = star_frames(raw, staging, star)
    assert shuffles(fact, capsys) == 1
    assert fact.count() == fact.distinct().count() < 7 * 24


def test_load_star_writes_every_table(spark, tmp_path):
    folder = str(tmp_path / "star")
    star = load_star(raw_weather(spark), folder)
    assert sorted(p.name for p in (tmp_path / "star").iterdir()) == [
        "dim_city",
        "dim_precipitation",
        "dim_wind_direction",
        "fact_weather",
        "transformed_weather_info",
    ]
    assert star.cleaned.schema.simpleString() == WEATHER_STAR.cleaned.struct().simpleString()
    assert [tuple(r) for r in star.dimensions["dim_city"].orderBy("city_id").collect()] == [
        (1, "brae"),
        (2, "osto"),
        (3, "vell"),
    ]
    assert {n: m.rows for n, m in star.metrics.items()} == {
        "transformed_weather_info": 60,
        "dim_city": 3,
        "dim_wind_direction": 2,
        "dim_precipitation": 4,
        "fact_weather": 60,
    }
    row = star.fact.where("id = 1").first()
    assert (row.city_id, row.wind_dir_id, row.wind_speed) == (3, 2, Decimal("0.13"))
    for spec in WEATHER_STAR.dimensions:
        dim = star.dimensions[spec.table]
        assert ops.duplicate_keys(dim, [spec.key]).count() == 0
        assert ops.orphan_keys(star.fact, spec.key, dim, spec.key).count() == 0


def test_side_by_side_writes_keep_their_own_counts(spark, tmp_path):
    """Metrics of tables written at the same time are not mixed up, nor is the job group lost."""
    context = spark.sparkContext
    context.setJobGroup("star-load", "side by side")
    try:
        for i in range(4):
            star = load_star(raw_weather(spark, 24 + i), str(tmp_path / "star"))
            for table, df in {**star.dimensions, "fact_weather": star.fact}.items():
                assert star.metrics[table].rows == df.count()
        assert len(context.statusTracker().getJobIdsForGroup("star-load")) > 8
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)


def test_load_star_replaces_older_tables(spark, tmp_path):
    folder = str(tmp_path / "star")
    load_star(raw_weather(spark, 60), folder)
    assert load_star(raw_weather(spark, 30), folder).fact.count() == 30
    assert len(list((tmp_path / "star").iterdir())) == 5


def test_broken_keys_stop_the_load(spark, tmp_path, monkeypatch):
    from wxpipe.plans import IntegrityError, pipelines

    folder = str(tmp_path / "star")
    load_star(raw_weather(spark, 60), folder, audit=True)
    build = pipelines.build_fact
    monkeypatch.setattr(
        pipelines, "build_fact", lambda *a, **k: build(*a, **k).withColumn("city_id", F.lit(99))
    )
    with pytest.raises(IntegrityError, match="fk dim_city"):
        load_star(raw_weather(spark, 30), folder, audit=True)
    assert spark.read.parquet(f"{folder}/fact_weather").count() == 60


def test_audit_names_every_broken_key(spark):
    specs = WEATHER_STAR.dimensions
    dims = {
        s.table: spark.createDataFrame([(1, "a"), (2, "b")], f"{s.key} int, {s.attribute} string")
        for s in specs
    }
    dims["dim_city"] = dims["dim_city"].unionByName(dims["dim_city"].where("city_id = 2"))
    fact = spark.createDataFrame(
        [(1, 1, 7), (2, 2, 7), (2, None, 1)], "city_id int, wind_dir_id int, precipitation_id int"
    )
    assert rows(ops.audit_star(fact, dims, WEATHER_STAR)) == [
        ("fk dim_precipitation", 7, 2),
        ("pk dim_city", 2, 2),
    ]


def test_failed_load_leaves_the_old_tables(spark, tmp_path):
    folder = str(tmp_path / "star")
    load_star(raw_weather(spark, 60), folder)
    too_hot = raw_weather(spark, 30).withColumn("temperature", F.col("temperature") * 1e8)
    with pytest.raises(Exception, match="temperature"):
        load_star(too_hot, folder)
    left = spark.read.parquet(f"{folder}/fact_weather")
    assert left.count() == 60
    assert len(list((tmp_path / "star").iterdir())) == 5


def test_one_city_empties_the_fact_unless_protected(spark, staging):
    raw = staging.write(raw_weather(spark, city=lambda i: "osto"), "raw")
    cleaned, dimensions, fact = star_frames(raw, staging)
    assert cleaned.where("city IS NOT NULL").count() == 0
    assert rows(dimensions["dim_city"].frame) == [(1, None)]
    assert fact.count() == 0
    assert star_frames(raw, staging, protect=["city"])[2].count() == 60


def test_shuffles_are_sized_for_the_load(spark):
    from wxpipe.session import partitions_for, row_bytes, sized

    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    assert row_bytes(WEATHER_MESSAGE) == 8 * 11 + 24 * 3
    assert partitions_for(2**40) == 8192
    assert partitions_for(100 * 2**40) == 32_768
    large, small = sized(spark.range(9), 1 << 40), sized(spark.range(9), 1)
    assert large.sparkSession.conf.get(key) == "8192"
    assert small.sparkSession.conf.get(key) == before == spark.conf.get(key)
    assert rows(large) == rows(spark.range(9))
    zone = "spark.sql.session.timeZone"
    assert large.sparkSession.conf.get(zone) == spark.conf.get(zone)
    assert shared_folder(large.sparkSession) == shared_folder(spark)
    assert not [t for t in spark.catalog.listTables("global_temp") if t.name.startswith("own_")]


def test_two_loads_at_once_keep_their_own_sizes(spark, staging, monkeypatch):
    """Also of a fact that is evaluated only after both."""
    from concurrent.futures import ThreadPoolExecutor

    from wxpipe.plans import pipelines

    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    monkeypatch.setattr(pipelines, "row_bytes", lambda schema: 1 << 30)
    raws = [staging.write(raw_weather(spark, n), f"raw{n}") for n in (20, 60)]
    with ThreadPoolExecutor(2) as pool:
        loads = list(pool.map(lambda raw: star_frames(raw, Staging(spark, staging.root)), raws))
    facts = [fact for _, _, fact in loads]
    assert [f.sparkSession.conf.get(key) for f in facts] == ["160", "480"]
    assert spark.conf.get(key) == before
    assert [f.count() for f in facts] == [20, 60]


def test_planning_a_lookup_starts_no_job(spark, staging):
    raw = staging.write(raw_weather(spark), "raw")
    cleaned, dimensions, _ = star_frames(raw, staging)
    context = spark.sparkContext
    context.setJobGroup("planning", "lookups")
    try:
        fact = ops.build_fact(
            cleaned, WEATHER_STAR, dimensions, broadcast_bytes=0, rows_per_task=5
        )
        assert not context.statusTracker().getJobIdsForGroup("planning")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)
    assert fact.count() == 60


def test_hot_bytes_never_understates(spark, staging):
    spec = [d for d in WEATHER_STAR.dimensions if d.attribute == "city"]
    names = [f"c{n:0{n}d}" for n in range(1, 12)]
    held = [(name,) for n, name in enumerate(names) for _ in range(3**n % 40 + 1)]
    raw = spark.createDataFrame(held, "city string")
    dimension = ops.build_dimensions(raw, spec, staging, "widths")["dim_city"]
    counts = raw.groupBy("city").count().collect()
    for limit in (1, 2, 7, 20, 39, 40, 100, 3_000_000):
        exact = sum(64 + len(r.city) for r in counts if r["count"] > limit)
        assert exact <= dimension.hot_bytes(limit) <= dimension.n_bytes


def test_failed_swap_leaves_the_whole_old_star(spark, staging, tmp_path, monkeypatch):
    """Keys are numbered anew by every load: an old fact must never meet new dimensions."""
    folder = str(tmp_path / "star")

    def wide():
        stored = {t: spark.read.parquet(f"{folder}/{t}") for t in ("fact_weather", "dim_city")}
        joined = stored["fact_weather"].join(stored["dim_city"], "city_id")
        return {(r.id, r.city) for r in joined.select("id", "city").collect()}

    load_star(staging.write(raw_weather(spark), "first"), folder)
    before = wide()
    fewer = staging.write(raw_weather(spark).where(f"city <> '{min(CITIES)}'"), "second")

    def fails(*_):
        raise OSError("no")

    with monkeypatch.context() as patch:
        patch.setattr("wxpipe.plans.pipelines.swap_in", fails)
        with pytest.raises(OSError, match="no"):
            load_star(fewer, folder)
    assert wide() == before
    load_star(fewer, folder)
    assert wide() == {(i, city) for i, city in before if city != min(CITIES)}
    assert [p.name for p in tmp_path.iterdir()] == ["star"]


def test_a_star_is_read_whole_while_it_is_swapped(spark, staging, tmp_path, monkeypatch):
    """Dying in the swap leaves one load's tables to readers, and the next load goes on."""
    from wxpipe.plans import read_star
    from wxpipe.sinks import tables

    folder = str(tmp_path / "star")
    load_star(staging.write(raw_weather(spark, 60), "first"), folder)
    assert read_star(spark, folder).fact.count() == 60
    real, calls = tables.move, []

    def dies(*args):
        calls.append(args)
        if len(calls) == 2:
            raise KeyboardInterrupt
        real(*args)

    with monkeypatch.context() as patch:
        patch.setattr(tables, "move", dies)
        patch.setattr(tables, "_undo", lambda *_: None)
        patch.setattr(tables, "delete", lambda *_: None)
        patch.setattr(Staging, "clear", lambda *_: None)
        with pytest.raises(KeyboardInterrupt):
            load_star(staging.write(raw_weather(spark, 30), "second"), folder)
    star = read_star(spark, folder)
    assert star.fact.count() == star.cleaned.count() == 30
    joined = star.fact.join(star.dimensions["dim_city"], "city_id")
    assert joined.count() == 30
    load_star(staging.write(raw_weather(spark, 20), "third"), folder)
    assert read_star(spark, folder).fact.count() == 20
    assert spark.read.parquet(f"{folder}/fact_weather").count() == 20


def test_a_star_refuses_a_folder_with_other_tables(spark, staging, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "star/mine"))
    with pytest.raises(ValueError, match="mine"):
        load_star(staging.write(raw_weather(spark), "raw"), str(tmp_path / "star"))


def test_hot_threshold_does_not_grow_with_the_fact(spark, staging):
    for rows_per_member in (10, 1000):
        raw = raw_weather(spark, n=3).crossJoin(spark.range(rows_per_member).select()).select("*")
        spec = [d for d in WEATHER_STAR.dimensions if d.attribute == "city"]
        built = ops.build_dimensions(raw, spec, staging, f"hot-{rows_per_member}")
        dimension = built[spec[0].table]
        assert (dimension.hot_bytes(50) > 0) == (rows_per_member > 50)
        assert dimension.hot_bytes(2000) == 0
        joined = ops.lookup_join(raw, dimension, broadcast_bytes=0, rows_per_task=50)
        assert joined.count() == 3 * rows_per_member
