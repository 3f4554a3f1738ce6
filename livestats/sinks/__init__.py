"""Sinks K1-K5: console, JDBC append, JDBC upsert, topic, partitioned files.

Stream sinks are ``foreachBatch`` handlers (``fn(batch_df, batch_id)``) or
writer factories; batch sinks take a DataFrame.  Connection details always
come from the caller; nothing is hard-coded.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The jobs' flush settings (rows per batch).
LAUNCH_BATCH_ROWS = 100
GIFT_BATCH_ROWS = 5
DEMO_BATCH_ROWS = 1000


# ---- K1 console ---------------------------------------------------------------------

def console(df: DataFrame, output_mode: str = "update", truncate: bool = False):
    """K1: print each micro-batch (``memory`` is used in tests instead)."""
    return df.writeStream.format("console").outputMode(output_mode).option("truncate", str(truncate).lower())


# ---- K2 / K3 JDBC ------------------------------------------------------------------------

@dataclass
class JdbcOptions:
    url: str
    table: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    batch_rows: int = LAUNCH_BATCH_ROWS
    extra: dict[str, str] = field(default_factory=dict)

    def writer_options(self) -> dict[str, str]:
        o = {"url": self.url, "dbtable": self.table, "batchsize": str(self.batch_rows)}
        if self.user:
            o["user"] = self.user
        if self.password:
            o["password"] = self.password
        if self.driver:
            o["driver"] = self.driver
        o.update(self.extra)
        return o


def jdbc_append(opts: JdbcOptions) -> Callable[[DataFrame, int], None]:
    """K2: ``foreachBatch`` handler appending each micro-batch in JDBC batches
    of ``batch_rows``.  The flush interval is the stream's trigger interval;
    retries are Spark's task retries."""
    def handle(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.write.format("jdbc").options(**opts.writer_options()).mode("append").save()
    return handle


# Which upsert a database has, by the start of its JDBC address.
UPSERT_DIALECTS = {"jdbc:mysql:": "duplicate key", "jdbc:mariadb:": "duplicate key",
                   "jdbc:postgresql:": "conflict", "jdbc:sqlite:": "conflict"}


def upsert_dialect(url: str) -> str:
    return next((d for prefix, d in UPSERT_DIALECTS.items() if url.startswith(prefix)), "merge")


def upsert_sql(dialect: str, target: str, staging: str, keys: list[str], cols: list[str]) -> str:
    """The statement that upserts ``staging`` into ``target`` on ``keys``, in a database's own dialect."""
    if dialect == "merge":
        return merge_sql(target, staging, keys, cols)
    names = ", ".join(cols)
    rest = [c for c in cols if c not in keys]
    insert = f"INSERT INTO {target} ({names}) SELECT {names} FROM {staging}"
    if dialect == "duplicate key":
        return f"{insert} ON DUPLICATE KEY UPDATE " + ", ".join(f"{c} = VALUES({c})" for c in rest or keys)
    if dialect == "conflict":
        what = "UPDATE SET " + ", ".join(f"{c} = excluded.{c}" for c in rest) if rest else "NOTHING"
        return f"{insert} WHERE TRUE ON CONFLICT ({', '.join(keys)}) DO {what}"
    raise ValueError(f"unknown upsert dialect {dialect!r}")


def merge_sql(target: str, staging: str, keys: list[str], cols: list[str]) -> str:
    """The MERGE that upserts ``staging`` into ``target`` on ``keys``."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    upd = ", ".join(f"{c} = s.{c}" for c in cols if c not in keys)
    ins_cols = ", ".join(cols)
    ins_vals = ", ".join(f"s.{c}" for c in cols)
    return (f"MERGE INTO {target} t USING {staging} s ON {on} "
            f"WHEN MATCHED THEN UPDATE SET {upd} "
            f"WHEN NOT MATCHED THEN INSERT ({ins_cols}) VALUES ({ins_vals})")


def jdbc_upsert(opts: JdbcOptions, keys: list[str], staging_table: str | None = None,
                dialect: str | None = None) -> Callable[[DataFrame, int], None]:
    """K3: ``foreachBatch`` handler upserting each micro-batch keyed by ``keys``.

    The batch (one row per key: the update-mode output of a running
    aggregate) is written to a staging table, then one statement moves it into
    the target, in the dialect of the database (by default by its address).  A
    retried batch writes the same staging rows and the statement sets the same
    values, so the upsert is idempotent.
    """
    dialect = dialect or upsert_dialect(opts.url)
    staging = staging_table or f"{opts.table}_staging"

    def handle(batch_df: DataFrame, batch_id: int) -> None:
        stage_opts = dict(opts.writer_options(), dbtable=staging, truncate="true")
        batch_df.write.format("jdbc").options(**stage_opts).mode("overwrite").save()
        sql = upsert_sql(dialect, opts.table, staging, keys, batch_df.columns)
        jvm = batch_df.sparkSession.sparkContext._jvm
        conn = jvm.java.sql.DriverManager.getConnection(opts.url, opts.user, opts.password) \
            if opts.user else jvm.java.sql.DriverManager.getConnection(opts.url)
        try:
            stmt = conn.createStatement()
            stmt.executeUpdate(sql)
            stmt.close()
        finally:
            conn.close()
    return handle


# ---- K4 topic ----------------------------------------------------------------------------------

def topic_records(df: DataFrame, key_col: str = "record_id", value_col: str = "value") -> DataFrame:
    """K4 rows: (key, value) as strings.  The key is the source record id, so
    consumers can drop the duplicates an at-least-once topic sink may write."""
    return df.select(F.col(key_col).cast("string").alias("key"), F.col(value_col).cast("string").alias("value"))


def topic_writer(df: DataFrame, bootstrap_servers: str, topic: str, checkpoint: str,
                 key_col: str = "record_id", value_col: str = "value"):
    """K4: stream (key, value) to a topic; at-least-once, keyed for de-duplication."""
    return (topic_records(df, key_col, value_col).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic)
            .option("checkpointLocation", checkpoint))


# ---- K5 partitioned files ------------------------------------------------------------------------

def write_partitioned(df: DataFrame, path: str, parts=("date", "hour"), mode: str = "append",
                      fmt: str = "parquet") -> None:
    """K5 (batch): land rows under ``date=.../hour=...`` folders.

    Rows are clustered by the partition columns first, so each task writes
    few files per partition instead of one per partition per task.  The
    rebalance lets adaptive execution split an hour that holds much of the
    data into several tasks, which a repartition by column would not.
    """
    (df.hint("rebalance", *[F.col(p) for p in parts]).write.mode(mode).partitionBy(*parts).format(fmt).save(path))


def partitioned_files(df: DataFrame, path: str, checkpoint: str, parts=("date", "hour"), fmt: str = "parquet"):
    """K5 (stream): the file sink is exactly-once (its log records the files of
    each batch)."""
    return (df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
            .partitionBy(*parts).outputMode("append"))


def read_partitioned(spark, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """Read a K5 landing back with its own schema, so the string partition
    values (``20240101``, ``00``) are not re-typed as numbers by discovery."""
    return spark.read.schema(schema).format(fmt).load(path)


def path_exists(spark, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def write_batch(df: DataFrame, base: str, batch_id: int, fmt: str = "parquet") -> None:
    """Land one micro-batch under ``base/batch_id=N`` exactly once.

    Spark's default commit protocol publishes a job's files only at job
    commit, together with ``_SUCCESS``; a folder that has it is final and a
    retried batch leaves it alone.  A downstream file stream therefore never
    sees the same batch twice (an overwrite would give the rows new file
    names, which a file source reads again).
    """
    path = f"{base.rstrip('/')}/batch_id={batch_id}"
    if path_exists(df.sparkSession, f"{path}/_SUCCESS"):
        return
    df.write.mode("overwrite").format(fmt).save(path)
