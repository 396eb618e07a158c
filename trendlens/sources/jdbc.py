"""A database sink that a replayed micro-batch cannot write twice.

Spark's JDBC writer commits partition by partition, so a batch that fails
half-way, or is replayed after a crash, leaves rows twice.  Here the tasks
write to a staging table, and one transaction on the driver's connection
moves the staged rows into the target and notes the batch in a ledger whose
primary key is the batch id.  Either both are there or neither; a batch that
the ledger knows is skipped.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from trendlens.sources.sinks import EPOCH_BITS, TREND_ROW_FIELDS, JdbcTrendSink


def connect(spark: SparkSession, url: str, properties: dict[str, str]):
    """A driver-side JDBC connection, by the ``driver`` class if one is named
    (also one that only the session's class loader knows)."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    props = jvm.java.util.Properties()
    for key, value in properties.items():
        props.setProperty(key, value)
    if "driver" not in properties:
        return jvm.java.sql.DriverManager.getConnection(url, props)
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    kind = jvm.java.lang.Class.forName(properties["driver"], True, loader)
    driver = kind.getDeclaredConstructor(gateway.new_array(jvm.java.lang.Class, 0)).newInstance(
        gateway.new_array(jvm.java.lang.Object, 0))
    return driver.connect(url, props)


@contextmanager
def transaction(spark: SparkSession, url: str, properties: dict[str, str]):
    """A connection whose statements are committed together, or not at all."""
    conn = connect(spark, url, properties)
    try:
        conn.setAutoCommit(False)
        try:
            yield conn
            conn.commit()
        except BaseException:
            conn.rollback()
            raise
    finally:
        conn.close()


def execute(conn, sql: str) -> int:
    statement = conn.createStatement()
    try:
        return statement.executeUpdate(sql)
    finally:
        statement.close()


def scalar(conn, sql: str):
    """First column of the first row of a query as a whole number, or None."""
    statement = conn.createStatement()
    try:
        rows = statement.executeQuery(sql)
        if not rows.next():
            return None
        value = rows.getLong(1)
        return None if rows.wasNull() else value
    finally:
        statement.close()


def table_exists(conn, table: str) -> bool:
    """Whether a table (``name`` or ``schema.name``, any case) exists."""
    *schema, name = table.lower().split(".")
    found = conn.getMetaData().getTables(None, None, None, None)
    while found.next():
        if found.getString(3).lower() == name and (not schema or (found.getString(2) or "").lower() == schema[-1]):
            return True
    return False


class LedgerJdbcTrendSink(JdbcTrendSink):
    """Write each micro-batch to ``table`` exactly once.

    ``<table>_staging`` (the target's columns) and ``<table>_batches`` (the
    ledger: batch_id, rows) are made at the first batch; a target that does
    not exist is created by Spark's JDBC writer.  One query at a time may
    write to a target.
    """

    def __init__(self, *args, **kwargs):
        super().__init__(*args, **kwargs)
        self.staging, self.ledger = f"{self.table}_staging", f"{self.table}_batches"

    def _transaction(self, spark):
        return transaction(spark, self.url, self.properties)

    def _tables(self, spark, rows: DataFrame) -> None:
        with self._transaction(spark) as conn:
            missing = [t for t in (self.table, self.staging, self.ledger) if not table_exists(conn, t)]
        if self.table in missing:
            super().__call__(rows.select(*TREND_ROW_FIELDS).limit(0), 0)
        with self._transaction(spark) as conn:
            columns = ", ".join(f'"{c}"' for c in TREND_ROW_FIELDS)
            if self.staging in missing:
                execute(conn, f"CREATE TABLE {self.staging} AS SELECT {columns} FROM {self.table} WITH NO DATA")
            if self.ledger in missing:
                execute(conn, f"CREATE TABLE {self.ledger} (batch_id BIGINT NOT NULL PRIMARY KEY, n_rows BIGINT)")

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        self._tables(spark, rows)
        with self._transaction(spark) as conn:
            if scalar(conn, f"SELECT COUNT(*) FROM {self.ledger} WHERE batch_id = {int(batch_id)}"):
                return
            execute(conn, f"DELETE FROM {self.staging}")
        held = rows if rows.is_cached else rows.persist()
        try:
            n = held.count()
            held.select(*TREND_ROW_FIELDS).write.jdbc(self.url, self.staging, mode="append", properties=self.properties)
        finally:
            if held is not rows:
                held.unpersist()
        columns = ", ".join(f'"{c}"' for c in TREND_ROW_FIELDS)
        with self._transaction(spark) as conn:
            staged = scalar(conn, f"SELECT COUNT(*) FROM {self.staging}")
            if staged != n:  # a lost task's rows beside those of its second run
                raise RuntimeError(f"{self.staging} holds {staged} rows of batch {batch_id} instead of {n}")
            execute(conn, f"INSERT INTO {self.ledger} VALUES ({int(batch_id)}, {n})")
            execute(conn, f"INSERT INTO {self.table} ({columns}) SELECT {columns} FROM {self.staging}")
            execute(conn, f"DELETE FROM {self.staging}")

    def next_epoch(self, spark) -> int:
        with self._transaction(spark) as conn:
            if not table_exists(conn, self.ledger):
                return super().next_epoch(spark)
            last = scalar(conn, f"SELECT MAX(batch_id) FROM {self.ledger}")
        return super().next_epoch(spark) if last is None else max((last >> EPOCH_BITS) + 1, super().next_epoch(spark))
