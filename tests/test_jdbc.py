"""JDBC paths without a database: what Spark's reader and writer are asked to do."""

import pytest
from py4j.protocol import Py4JJavaError

from wxpipe.schemas import FACT_WEATHER, TRANSFORMED_WEATHER, WEATHER_STAR
from wxpipe.sinks import jdbc_append, jdbc_landing, jdbc_refresh, jdbc_refresh_all
from wxpipe.sources import JdbcEndpoint, jdbc_table

ENDPOINT = JdbcEndpoint("jdbc:none://db/weather", "u", "p")


class Recorder:
    """Stands in for a reader or writer and keeps the options of every action."""

    def __init__(self, log, first=None, settings=None):
        self.log, self.row, self.settings = log, first, dict(settings or {})

    def _with(self, **more):
        return type(self)(self.log, self.row, {**self.settings, **more})

    @property
    def read(self):
        return Recorder(self.log, self.row)

    write = read

    def format(self, name):
        return self._with(format=name)

    def option(self, key, value):
        return self._with(**{key: value})

    def options(self, **more):
        return self._with(**more)

    def mode(self, name):
        return self._with(mode=name)

    def load(self):
        self.log.append(self.settings)
        return self

    save = load

    def first(self):
        return self.row

    def jdbc(self, url, table, predicates, properties):
        self.log.append(
            {"url": url, "table": table, "predicates": predicates, "properties": properties}
        )
        return self


class Database:
    """Stands in for a connection: keeps statements, and what was committed or taken back."""

    def __init__(self, entered=0, fail_on=None):
        self.entered, self.fail_on = entered, fail_on
        self.committed, self.pending, self.log = [], [], []

    def __call__(self, _spark, _endpoint):
        self.log.append("open")
        return self

    def setAutoCommit(self, on):  # noqa: N802 - names of the Java interface
        assert on is False

    def prepareStatement(self, sql):  # noqa: N802
        return Statement(self, sql)

    def commit(self):
        self.committed += self.pending
        self.pending = []

    def rollback(self):
        self.log.append("rollback")
        self.pending = []

    def close(self):
        assert not self.pending
        self.log.append("close")


class Statement:
    def __init__(self, database, sql):
        self.database, self.sql, self.values = database, sql, {}

    def setString(self, n, value):  # noqa: N802
        self.values[n] = value

    setLong = setString  # noqa: N815

    def executeUpdate(self):  # noqa: N802
        if self.database.fail_on and self.database.fail_on in self.sql:
            raise RuntimeError("refused")
        self.database.pending.append((self.sql, *self.values.values()))
        return 2

    def executeQuery(self):  # noqa: N802
        return self

    def next(self):
        return True

    def getLong(self, _n):  # noqa: N802
        return self.database.entered

    def close(self):
        pass


@pytest.fixture
def written(monkeypatch):
    """Tables written through Spark: name, mode, columns, declared types."""
    from wxpipe.sinks import jdbc

    log = []

    class Writer(Recorder):
        def save(self):
            names = self.row.columns
            kept = self.settings
            types = kept.get("createTableColumnTypes")
            log.append((kept["dbtable"], kept["mode"], names, types))

    real = jdbc._writer

    def writer(df, *args):
        class Frame:
            write = Writer(log, first=df)

        return real(Frame, *args)

    monkeypatch.setattr(jdbc, "_writer", writer)
    return log


def test_plain_read():
    log = []
    jdbc_table(Recorder(log), ENDPOINT, "weather_info")
    assert log == [
        {
            "format": "jdbc",
            "url": "jdbc:none://db/weather",
            "user": "u",
            "password": "p",
            "fetchsize": 10_000,
            "dbtable": "weather_info",
        }
    ]


def test_partitioned_read_asks_for_the_bounds_first():
    log = []
    reader = Recorder(log, first=(1, 900, 1000, 1000))
    jdbc_table(reader, ENDPOINT, "weather_info", "id", num_partitions=8)
    bounds, read = log
    assert bounds["query"] == (
        "SELECT min(id) AS lo, max(id) AS hi, count(*) AS n_rows, count(id) AS n_filled "
        "FROM weather_info"
    )
    assert "dbtable" not in bounds and (read["url"], read["table"]) == (ENDPOINT.url, "weather_info")
    assert read["properties"] == {"user": "u", "password": "p", "fetchsize": "10000"}
    assert len(read["predicates"]) == 8
    assert read["predicates"][-1].endswith("OR id IS NULL")


def test_rows_without_a_split_value_are_cut_too():
    log = []
    reader = Recorder(log, first=(1, 900, 1000, 400))
    jdbc_table(reader, ENDPOINT, "weather_info", "id", num_partitions=10, slice_by="hashtext(city)")
    nulls = [c for c in log[1]["predicates"] if "IS NULL" in c]
    assert len(nulls) == 6 and len(log[1]["predicates"]) == 10
    log.clear()
    reader = Recorder(log, first=(None, None, 1000, 0))
    jdbc_table(reader, ENDPOINT, "weather_info", "id", num_partitions=10, slice_by="hashtext(city)")
    assert len([c for c in log[1]["predicates"] if "IS NULL" in c]) == 10


def test_partitioned_read_of_an_empty_table_is_not_split():
    log = []
    jdbc_table(Recorder(log, first=(None, None, 0, 0)), ENDPOINT, "weather_info", "id")
    assert log[-1]["dbtable"] == "weather_info" and "predicates" not in log[-1]


def test_append():
    log = []
    jdbc_append(Recorder(log), ENDPOINT, "weather_info", connections=4, batch_size=500)
    assert log[0]["mode"] == "append" and log[0]["dbtable"] == "weather_info"
    assert (log[0]["numPartitions"], log[0]["batchsize"]) == (4, 500)


def test_refresh_truncates_and_declares_lengths():
    log = []
    jdbc_refresh(Recorder(log), ENDPOINT, TRANSFORMED_WEATHER)
    jdbc_refresh(Recorder(log), ENDPOINT, FACT_WEATHER)
    assert [entry["mode"] for entry in log] == ["overwrite", "overwrite"]
    assert all(entry["truncate"] for entry in log)
    assert not any("cascadeTruncate" in entry for entry in log)
    jdbc_refresh(Recorder(log), ENDPOINT, FACT_WEATHER, cascade=True)
    assert log[-1]["cascadeTruncate"]
    assert "city VARCHAR(100)" in log[0]["createTableColumnTypes"]
    assert "createTableColumnTypes" not in log[1]


def sensors(spark):
    return spark.createDataFrame([(1, "x", None), (2, None, "junk")], "id int, date string, bad string")


def test_a_batch_and_its_ledger_entry_are_one_write(spark, written):
    database = Database()
    store = jdbc_landing(ENDPOINT, "temperature_info", stream="s", connect=database)
    store(sensors(spark).drop("bad"), 7)
    incoming = written[-1][0]
    assert incoming.startswith("temperature_info_in_")
    assert written == [
        ("temperature_info", "append", ["id", "date"], None),
        (incoming, "overwrite", ["id", "date", "ingest_row"], None),
    ]
    create, insert, enter, drop = database.committed
    assert create[0].startswith('CREATE TABLE IF NOT EXISTS "temperature_info_batches"')
    assert "PRIMARY KEY (ingest_stream, ingest_batch)" in create[0]
    assert insert[0] == (
        'INSERT INTO "temperature_info" ("id", "date") SELECT "id", "date" FROM '
        f'(SELECT DISTINCT "id", "date", "ingest_row" FROM "{incoming}") arrived'
    )
    assert enter == ('INSERT INTO "temperature_info_batches" VALUES (?, ?, ?)', "s", 7, 2)
    assert drop == (f'DROP TABLE "{incoming}"',)
    assert database.log == ["open", "close", "open", "close"]


def test_a_batch_in_the_ledger_is_not_stored_again(spark, written):
    database = Database(entered=1)
    jdbc_landing(ENDPOINT, "t", stream="s", connect=database)(sensors(spark), 7)
    assert not written and len(database.committed) == 1


def test_a_refused_ledger_entry_takes_the_rows_back(spark, written):
    database = Database(fail_on='INSERT INTO "t_batches"')
    with pytest.raises(RuntimeError, match="refused"):
        jdbc_landing(ENDPOINT, "t", stream="s", connect=database)(sensors(spark), 7)
    assert len(database.committed) == 1 and "rollback" in database.log


def test_rejected_messages_go_to_their_own_table(spark, written):
    database = Database()
    store = jdbc_landing(ENDPOINT, "t", stream="s", rejected="bad", connect=database)
    store(sensors(spark), 0)
    assert [(name, columns) for name, _, columns, _ in written[:2]] == [
        ("t", ["id", "date"]),
        ("t_rejected", ["bad"]),
    ]
    good, bad = [sql for sql, *_ in database.committed if "SELECT DISTINCT" in sql]
    assert good.startswith('INSERT INTO "t" ("id", "date")') and 'WHERE "bad" IS NULL' in good
    assert bad.startswith('INSERT INTO "t_rejected" ("bad")') and 'WHERE "bad" IS NOT NULL' in bad


def test_a_batch_outside_a_stream_needs_a_name(spark):
    with pytest.raises(RuntimeError, match="stream name"):
        jdbc_landing(ENDPOINT, "t", connect=Database())(sensors(spark), 0)


def star_tables(spark):
    specs = WEATHER_STAR.dimensions[:1]
    dims = [(WEATHER_STAR.dimension_contract(s), spark.range(1).toDF(s.key)) for s in specs]
    return [*dims, (FACT_WEATHER, spark.range(2).toDF("id"))]


def test_a_set_of_tables_is_refreshed_in_one_transaction(spark, written):
    database = Database()
    jdbc_refresh_all(star_tables(spark), ENDPOINT, connect=database)
    assert [(name, mode) for name, mode, *_ in written] == [
        ("dim_city", "append"),
        ("dim_city_in", "overwrite"),
        ("fact_weather", "append"),
        ("fact_weather_in", "overwrite"),
    ]
    assert written[0][3] == written[1][3] == "city VARCHAR(100)"
    done = [" ".join(sql.split()[:3]) for sql, *_ in database.committed]
    assert done == [
        'DELETE FROM "fact_weather"',
        'DELETE FROM "dim_city"',
        'INSERT INTO "dim_city"',
        'INSERT INTO "fact_weather"',
        'DROP TABLE "dim_city_in"',
        'DROP TABLE "fact_weather_in"',
    ]
    assert database.log == ["open", "close"]


def test_a_failed_refresh_leaves_the_old_rows(spark, written):
    database = Database(fail_on='INSERT INTO "fact_weather"')
    with pytest.raises(RuntimeError, match="refused"):
        jdbc_refresh_all(star_tables(spark), ENDPOINT, connect=database)
    assert not database.committed and database.log == ["open", "rollback", "close"]


def test_unknown_database_is_reported(spark):
    with pytest.raises(Py4JJavaError, match="No suitable driver"):
        jdbc_table(spark, ENDPOINT, "weather_info")
