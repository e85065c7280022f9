"""Database tables as targets.

Spark's writer commits per task, so by itself it can neither take back a failed write nor tell a
repeated one. Here all rows first go to a table of their own beside the target, in parallel; then one
transaction on one connection moves them over inside the database. Rows are numbered on their
way, so a task that ran twice counts once.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from ..functions.names import column
from ..schemas import TableContract
from ..sources.jdbc import JdbcEndpoint

_ROW = "ingest_row"
_QUERY_ID = "sql.streaming.queryId"
Connect = Callable[[SparkSession, JdbcEndpoint], object]


def column_types(contract: TableContract) -> str:
    """``createTableColumnTypes`` text that gives declared text lengths to the database."""
    return ", ".join(
        f"{c.name} VARCHAR({c.max_length})" for c in contract.columns if c.max_length is not None
    )


def _writer(
    df: DataFrame, endpoint: JdbcEndpoint, table: str, connections: int, batch_size: int
) -> DataFrameWriter:
    return (
        df.write.format("jdbc")
        .options(**endpoint.options())
        .option("dbtable", table)
        .option("numPartitions", connections)
        .option("batchsize", batch_size)
    )


def jdbc_append(
    df: DataFrame,
    endpoint: JdbcEndpoint,
    table: str,
    connections: int = 16,
    batch_size: int = 10_000,
) -> None:
    """Add rows. Each task commits on its own, so a re-run task may add its rows again."""
    _writer(df, endpoint, table, connections, batch_size).mode("append").save()


def jdbc_refresh(
    df: DataFrame,
    endpoint: JdbcEndpoint,
    contract: TableContract,
    connections: int = 16,
    batch_size: int = 10_000,
    cascade: bool = False,
) -> None:
    """Replace a table's rows, keeping its definition where the database can truncate.

    ``cascade`` also empties the tables that refer to this one, where the database refuses to
    truncate it otherwise: refresh those afterwards. Readers see the table fill up; to avoid
    that, use :func:`jdbc_refresh_all`.
    """
    writer = _writer(df, endpoint, contract.name, connections, batch_size).option("truncate", True)
    if cascade:
        writer = writer.option("cascadeTruncate", True)
    types = column_types(contract)
    if types:
        writer = writer.option("createTableColumnTypes", types)
    writer.mode("overwrite").save()


# ---- one transaction --------------------------------------------------------------------


def open_connection(spark: SparkSession, endpoint: JdbcEndpoint):
    """A connection of the driver's JVM."""
    if endpoint.driver:
        spark._jvm.java.lang.Class.forName(
            endpoint.driver, True, spark._jvm.java.lang.Thread.currentThread().getContextClassLoader()
        )
    properties = spark._jvm.java.util.Properties()
    for name in ("user", "password"):
        if getattr(endpoint, name) is not None:
            properties.setProperty(name, getattr(endpoint, name))
    return spark._jvm.java.sql.DriverManager.getConnection(endpoint.url, properties)


class _Transaction:
    def __init__(self, connection):
        self._connection = connection

    def _prepared(self, sql: str, values: Sequence):
        statement = self._connection.prepareStatement(sql)
        for n, value in enumerate(values, start=1):
            (statement.setString if isinstance(value, str) else statement.setLong)(n, value)
        return statement

    def run(self, sql: str, *values: str | int) -> int:
        """Execute; the number of rows it changed."""
        statement = self._prepared(sql, values)
        try:
            return statement.executeUpdate()
        finally:
            statement.close()

    def number(self, sql: str, *values: str | int) -> int:
        """The single number that a query returns."""
        statement = self._prepared(sql, values)
        try:
            found = statement.executeQuery()
            found.next()
            return found.getLong(1)
        finally:
            statement.close()


@contextmanager
def transaction(spark: SparkSession, endpoint: JdbcEndpoint, connect: Connect = open_connection):
    """All statements run inside take effect together, or, if anything raises, none does."""
    connection = connect(spark, endpoint)
    try:
        connection.setAutoCommit(False)
        try:
            yield _Transaction(connection)
        except BaseException:
            connection.rollback()
            raise
        connection.commit()
    finally:
        connection.close()


def _quoted(name: str) -> str:
    return ".".join('"' + part.replace('"', '""') + '"' for part in name.split("."))


def _take_over(table: str, incoming: str, columns: Sequence[str], where: str = "") -> str:
    """SQL that copies the rows of ``incoming``, each numbered row once."""
    names = ", ".join(_quoted(c) for c in columns)
    rows = f"SELECT DISTINCT {names}, {_quoted(_ROW)} FROM {_quoted(incoming)}{where}"
    return f"INSERT INTO {_quoted(table)} ({names}) SELECT {names} FROM ({rows}) arrived"


def _create(df: DataFrame, endpoint: JdbcEndpoint, table: str, types: str = "") -> None:
    """An empty ``table`` with the columns of ``df``, if there is none yet."""
    writer = _writer(df.limit(0), endpoint, table, 1, 1)
    if types:
        writer = writer.option("createTableColumnTypes", types)
    writer.mode("append").save()


def _bring(
    df: DataFrame,
    endpoint: JdbcEndpoint,
    incoming: str,
    types: str,
    connections: int,
    batch_size: int,
) -> None:
    """Rows, numbered, in the table ``incoming``.

    A number says which task a row came from and where in it: the same when the task runs again.
    """
    numbered = df.withColumn(_ROW, F.monotonically_increasing_id())
    writer = _writer(numbered, endpoint, incoming, connections, batch_size)
    if types:
        writer = writer.option("createTableColumnTypes", types)
    writer.mode("overwrite").save()


def jdbc_landing(
    endpoint: JdbcEndpoint,
    table: str,
    stream: str | None = None,
    rejected: str | None = None,
    connections: int = 16,
    batch_size: int = 10_000,
    connect: Connect = open_connection,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends batch N of a stream to a table once.

    ``<table>_batches`` is the ledger: a row per stream and batch, with the number of rows it
    brought. A batch in the ledger is not stored again. Otherwise its rows arrive in a table of
    their own, and one transaction adds them to ``table`` and the batch to the ledger, whose key
    refuses a second entry. A stop at any point leaves a batch stored and entered, or neither.

    ``rejected`` names a column with the payloads of messages that could not be read; the same
    transaction puts those into ``<table>_rejected``.
    """
    ledger, refused = f"{table}_batches", f"{table}_rejected"

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = stream or spark.sparkContext.getLocalProperty(_QUERY_ID)
        if not name:
            raise RuntimeError("no stream name: call from foreachBatch or pass one")
        with transaction(spark, endpoint, connect) as work:
            work.run(
                f"CREATE TABLE IF NOT EXISTS {_quoted(ledger)} (ingest_stream VARCHAR(100) NOT NULL, "
                "ingest_batch BIGINT NOT NULL, n_rows BIGINT NOT NULL, "
                "PRIMARY KEY (ingest_stream, ingest_batch))"
            )
            entered = work.number(
                f"SELECT count(*) FROM {_quoted(ledger)} "
                "WHERE ingest_stream = ? AND ingest_batch = ?",
                name,
                batch_id,
            )
        if entered:
            return
        incoming = f"{table}_in_{zlib.crc32(name.encode()):08x}"
        columns = [c for c in batch.columns if c != rejected]
        good = f" WHERE {_quoted(rejected)} IS NULL" if rejected else ""
        _create(batch.select(*[column(c) for c in columns]), endpoint, table)
        if rejected:
            _create(batch.select(column(rejected)), endpoint, refused)
        _bring(batch, endpoint, incoming, "", connections, batch_size)
        with transaction(spark, endpoint, connect) as work:
            added = work.run(_take_over(table, incoming, columns, good))
            if rejected:
                bad = f" WHERE {_quoted(rejected)} IS NOT NULL"
                work.run(_take_over(refused, incoming, [rejected], bad))
            work.run(f"INSERT INTO {_quoted(ledger)} VALUES (?, ?, ?)", name, batch_id, added)
            work.run(f"DROP TABLE {_quoted(incoming)}")

    return store


def jdbc_refresh_all(
    tables: Sequence[tuple[TableContract, DataFrame]],
    endpoint: JdbcEndpoint,
    connections: int = 16,
    batch_size: int = 10_000,
    connect: Connect = open_connection,
) -> None:
    """Replace the rows of several tables in one transaction.

    ``tables`` come in the order of their references: dimensions before the facts that point at
    them. They are all brought beside their targets first, in parallel; the transaction then
    empties the targets, facts first, and fills them, facts last, so keys hold at every statement.
    Until it commits, readers see all old rows, and any failure leaves them.
    """
    if not tables:
        return
    spark = tables[0][1].sparkSession
    for contract, df in tables:
        types = column_types(contract)
        _create(df, endpoint, contract.name, types)
        _bring(df, endpoint, f"{contract.name}_in", types, connections, batch_size)
    with transaction(spark, endpoint, connect) as work:
        for contract, _ in reversed(tables):
            work.run(f"DELETE FROM {_quoted(contract.name)}")
        for contract, df in tables:
            work.run(_take_over(contract.name, f"{contract.name}_in", df.columns))
        for contract, _ in tables:
            work.run(f"DROP TABLE {_quoted(contract.name + '_in')}")
