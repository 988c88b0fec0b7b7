"""Table sinks: partitioned appends, the offset log, versions, delimited text.

Paths are whatever the caller passes: on a cluster, a shared filesystem
(the warehouse, or the folder ``spark.checkpoint.dir`` names).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.timefields import floor_div
from ledgerline.operators.codec import MissingConnectorError
from ledgerline.operators.offsets import OFFSET_LOG_COLUMNS
from ledgerline.operators.sequence import assign_sequence
from ledgerline.schemas import PARTITION_FIELDS
from ledgerline.session import scratch_path
from ledgerline.sources.delimited import CSV_OPTIONS, DELIMITER, escaped_line
from ledgerline.sources.log import BROADCAST_BOUNDS, LOG_COLUMNS, ORDER_COL, is_missing_source, read_log


def clustered(df: DataFrame, partition_cols) -> DataFrame:
    """Cluster rows by partition columns before a partitioned write.

    A ``rebalance`` hint, not a plain repartition: AQE coalesces small
    partitions and splits a skewed one (an hour holding a third of the rows)
    into several tasks, so no single task writes a hot partition alone.
    """
    return df.hint("rebalance", *partition_cols) if partition_cols else df


def _writer(df: DataFrame, partition_cols, mode: str, dynamic: bool):
    w = df.write.mode(mode).format("parquet")
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    return w


def path_missing(exc: Exception) -> bool:
    """Whether a read failed because there is nothing at its path - and for no other reason."""
    return isinstance(exc, AnalysisException) and exc.getCondition() == "PATH_NOT_FOUND"


def _same_columns(df: DataFrame, path: str) -> None:
    """Refuse to append to a folder that holds a table of other columns (another folder layout)."""
    try:
        there = df.sparkSession.read.parquet(path).columns
    except AnalysisException as exc:
        if path_missing(exc) or exc.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # nothing, or an empty folder
            return
        raise
    if set(there) != set(df.columns):
        raise ValueError(f"the table at {path} has columns {sorted(there)}, not {sorted(df.columns)}: another layout")


def append_partitioned(
    df: DataFrame,
    path: str | None = None,
    table: str | None = None,
    partition_cols: tuple[str, ...] | list[str] = PARTITION_FIELDS,
    cluster: bool = True,
) -> None:
    """K1: append to a Parquet table partitioned by ``mon, day, hour``.

    With ``cluster`` the rows are first clustered on the partition columns
    (see :func:`clustered`), so a directory gets few files.
    """
    if path and not table:
        _same_columns(df, path)
    data = clustered(df, partition_cols) if cluster else df
    w = _writer(data, partition_cols, "append", dynamic=False)
    if table:
        w.saveAsTable(table) if path is None else w.option("path", path).saveAsTable(table)
    elif path:
        w.save(path)
    else:
        raise ValueError("give a path or a table name")


def insert_into(spark: SparkSession, df: DataFrame, table: str) -> None:
    """K7's append: ``INSERT INTO`` an existing table by position, clustered by its partition columns."""
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    clustered(df, parts).write.insertInto(table)


def overwrite_partitions(df: DataFrame, path: str, partition_cols: list[str]) -> None:
    """Idempotent write: replace exactly the partitions present in ``df``.

    Re-running a batch with the same ``batch_id`` leaves one copy.
    """
    _writer(clustered(df, partition_cols), partition_cols, "overwrite", dynamic=True).save(path)


BATCH_COLUMNS = ("appname", "batch_id")
SMALL_BATCH_ROWS = 1_000_000
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder name of a NULL partition value


# The characters that Spark escapes (as %XX) in the folder names of partition values.
ESCAPED_IN_PATHS = frozenset('"#%\'*/:=?\\{[]^\x7f') | frozenset(map(chr, range(1, 0x20)))


def partition_folder(column: str, value: str) -> str:
    """``column=value`` as Spark names the folder of a partition value."""
    if not value:
        raise ValueError(f"{column} must not be empty")
    return f"{column}=" + "".join(f"%{ord(c):02X}" if c in ESCAPED_IN_PATHS else c for c in value)


def batch_path(path: str, appname: str, batch_id: int) -> str:
    """The folder of one app's batch."""
    return f"{path.rstrip('/')}/{partition_folder('appname', appname)}/batch_id={int(batch_id)}"


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def overwrite_batch(df: DataFrame, path: str, appname: str, batch_id: int, partition_cols: list[str], rows: int | None = None) -> None:
    """Idempotent batch write: ``<path>/appname=<app>/batch_id=<id>/`` is replaced as a whole.

    Apps that share a table never touch each other's folders.  Readers of ``path`` see ``appname`` and
    ``batch_id`` as partition columns ahead of the time columns; filters on the time columns still
    prune.  A batch of few ``rows`` is dealt over all cores by its partition columns, as AQE would
    leave one task to write every folder; a larger one is rebalanced (hot hours are split).
    """
    write_batch_folder(df, batch_path(path, appname, batch_id), partition_cols, rows)


def write_batch_folder(df: DataFrame, folder: str, partition_cols: list[str], rows: int | None = None) -> None:
    """The rows of one batch as the whole content of ``folder``."""
    small = rows is not None and rows <= SMALL_BATCH_ROWS and partition_cols
    cores = df.sparkSession.sparkContext.defaultParallelism
    data = df.repartition(cores, *partition_cols) if small else clustered(df, partition_cols)
    _writer(data, partition_cols, "overwrite", dynamic=False).save(folder)


def register_batch(spark: SparkSession, table: str, path: str, df: DataFrame, appname: str, batch_id: int, partition_cols: list[str]) -> None:
    """Show a written batch in the catalog table ``table`` over ``path``; the table is made if absent.

    Every partition is added with the folder that holds it, so no name has to be guessed.  A batch
    without rows (all its payloads bad) adds none.
    """
    if not spark.catalog.tableExists(table):
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        parts = ", ".join(f"`{c}`" for c in (*BATCH_COLUMNS, *partition_cols))
        spark.sql(f"CREATE TABLE {table} ({cols}, appname string, batch_id bigint) USING parquet PARTITIONED BY ({parts}) LOCATION {sql_text(path)}")
    folder = batch_path(path, appname, batch_id)
    try:
        found = spark.read.schema(df.schema).parquet(folder).select(*partition_cols).distinct().collect()  # the hours of one batch
    except AnalysisException as exc:
        if not path_missing(exc):
            raise
        found = []
    if not found:
        return
    shown = lambda v: NO_VALUE if v is None else str(int(v))
    specs = []
    for r in found:
        spec = [f"appname={sql_text(appname)}", f"batch_id={int(batch_id)}", *(f"`{c}`={'null' if r[c] is None else int(r[c])}" for c in partition_cols)]
        place = "/".join([folder, *(f"{c}={shown(r[c])}" for c in partition_cols)])
        specs.append(f"PARTITION ({', '.join(spec)}) LOCATION {sql_text(place)}")
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(specs))
    spark.catalog.refreshTable(table)


def compact(
    spark: SparkSession,
    src: str,
    dst: str,
    partition_cols: tuple[str, ...] | list[str] = PARTITION_FIELDS,
    drop: tuple[str, ...] = BATCH_COLUMNS,
) -> None:
    """Rewrite an ingest table (one folder per batch) as a compact new version.

    The per-batch layout that makes ingest idempotent leaves many small files;
    this writes the same rows, without the app and batch columns, clustered by the time
    partitions into ``dst`` (a new location: a table being read cannot be
    overwritten).  A ``rebalance`` keeps a hot hour from landing on one task.
    """
    rows = spark.read.parquet(src)
    rows = rows.drop(*[c for c in drop if c in rows.columns])
    data_cols = [c for c in rows.columns if c not in partition_cols]
    _writer(clustered(rows.select(*data_cols, *partition_cols), partition_cols), partition_cols,
            "errorifexists", dynamic=False).save(dst)


def write_offset_log(offset_rows: DataFrame, path: str, idempotent: bool = True) -> None:
    """K2: add offset-log rows; keyed by (appname, batch_id) so a retried batch replaces itself."""
    if idempotent:
        overwrite_partitions(offset_rows, path, ["appname", "batch_id"])
    else:
        _writer(offset_rows, [], "append", dynamic=False).save(path)


def compact_offset_log(spark: SparkSession, src: str, dst: str, files: int = 1) -> None:
    """Rewrite an offset log (a folder per batch) as few files per app, in order of ``batch_ts``.

    Every trigger adds a folder; the compact log's files and row groups cover narrow time ranges, so the
    ``batch_ts`` filters of a range look-up skip them by statistics.  ``dst`` is a new location."""
    rows = spark.read.parquet(src).select(*OFFSET_LOG_COLUMNS)
    ordered = rows.repartitionByRange(files, "appname", "batch_ts").sortWithinPartitions("appname", "batch_ts", "topic", "partition")
    ordered.write.mode("errorifexists").partitionBy("appname").parquet(dst)


def read_offset_log(spark: SparkSession, path: str) -> DataFrame:
    """The offset log written by :func:`write_offset_log`, in OFFSET_LOG column order."""
    return spark.read.parquet(path).select(*OFFSET_LOG_COLUMNS)


ENDS_DDL = "topic string, partition int, next long, publish string"  # publish: the id that took the offsets, if any


def log_ends(spark: SparkSession, path: str) -> DataFrame | None:
    """Next offset per (topic, partition): from the small table of ends that appends keep beside the log,
    or once from a log that has none; None if there is no log."""
    try:
        ends = spark.read.schema(ENDS_DDL).parquet(ends_path(path))
        return ends.groupBy("topic", "partition").agg(F.max("next").alias("next"))
    except AnalysisException as exc:
        if not path_missing(exc):
            raise
    try:
        return read_log(spark, path).groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next"))
    except AnalysisException as exc:
        if not path_missing(exc):
            raise
    return None


def ends_path(path: str) -> str:
    return path.rstrip("/") + "-ends"


def append_log(spark: SparkSession, path: str, messages: DataFrame, order_col: str = ORDER_COL) -> None:
    """K3 for a table-backed log: append messages with offsets that continue the log.

    ``messages`` has ``key value topic partition timestamp`` and an integral ``order_col``; each
    partition's new offsets start at its current end.  The new ends are recorded before the messages
    are written, so a failed append leaves a gap in the offsets, never an offset used twice.  One writer
    per log at a time, as with a partition leader.
    """
    numbered = number_messages(spark, path, messages, order_col)
    if _record_ends(spark, path, numbered):
        append_numbered(numbered, path)


def append_numbered(numbered: DataFrame, path: str) -> None:
    """Add messages that have their offsets to the log."""
    write_log(numbered, path, mode="append")


def number_messages(spark: SparkSession, path: str, messages: DataFrame, order_col: str, own: str | None = None) -> DataFrame:
    """``messages`` with the offsets that continue the log, computed and written once, to the folder
    ``own`` (else to a scratch folder)."""
    numbered = assign_sequence(messages, ["topic", "partition"], order_col, "offset")
    ends = log_ends(spark, path)
    if ends is not None:
        starts = ends.withColumnRenamed("next", "__next")
        starts = F.broadcast(starts) if starts.count() <= BROADCAST_BOUNDS else starts
        numbered = numbered.join(starts, ["topic", "partition"], "left").withColumn(
            "offset", F.col("offset") + F.coalesce("__next", F.lit(0)))
    own = own or scratch_path(spark, "numbered")
    numbered.select(*LOG_COLUMNS).write.mode("overwrite").parquet(own)
    return read_log(spark, own)


def _record_ends(spark: SparkSession, path: str, numbered: DataFrame) -> bool:
    """Record the log's ends after ``numbered``; False if it holds nothing."""
    ends = numbered.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next"))
    if ends.isEmpty():
        return False
    before = log_ends(spark, path)
    if before is not None:  # ends of partitions that this append does not touch
        ends = ends.unionByName(before).groupBy("topic", "partition").agg(F.max("next").alias("next"))
    target = scratch_path(spark, "ends")
    ends.write.parquet(target)
    spark.read.parquet(target).coalesce(1).write.mode("append").parquet(ends_path(path))
    return True


def write_log(log: DataFrame, path: str, mode: str = "errorifexists", slice_width: int = 1 << 22) -> None:
    """A message log at rest: one folder per (topic, partition), files in offset order.

    Rows are hash-partitioned on (topic, partition, offset div ``slice_width``):
    offsets are dense and unique within a partition, so a slice holds at most
    ``slice_width`` rows and a hot partition is spread over many tasks, without
    the sampling pass a range repartition would add (which would compute a
    derived log twice).  Sorted by offset within each task, files and row
    groups cover narrow offset ranges, so range reads skip them by statistics.
    """
    keys = ["topic", "partition", "offset"]
    sliced = log.repartition(F.col("topic"), F.col("partition"), floor_div("offset", slice_width))
    sliced.sortWithinPartitions(*keys).write.mode(mode).partitionBy("topic", "partition").parquet(path)


def publish_log(df: DataFrame, sink: str, fmt: str = "parquet", bootstrap_servers: str | None = None, publish_id: str | None = None) -> None:
    """K3: write keyed, routed messages (``plans.publish.publish``'s output).

    ``fmt="kafka"`` sends them to Kafka (needs the connector), which assigns offsets; its errors pass
    through.  ``parquet`` appends them to the log at ``sink`` with offsets that continue it, so
    ``read_log`` and replays read them back; under a ``publish_id`` a repeat adds nothing
    (``sinks.ledger``).
    """
    if fmt != "kafka":
        if publish_id is not None:
            from ledgerline.sinks.ledger import publish_once

            publish_once(df.sparkSession, sink, df, publish_id)
            return
        append_log(df.sparkSession, sink, df)
        return
    if publish_id is not None:
        raise ValueError("Kafka keeps no ledger of publish ids")
    try:
        df.select("key", "value", "topic", "partition").write.format("kafka").option(
            "kafka.bootstrap.servers", bootstrap_servers or "").save()
    except Exception as exc:
        if is_missing_source(exc, "kafka"):
            raise MissingConnectorError("publish_log needs the spark-sql-kafka package") from exc
        raise


# --- versions ---------------------------------------------------------------------

def version_names(table: str, version: str) -> dict[str, str]:
    """Names of a table's new version and of its deltas."""
    return {"version": f"{table}_{version}", "deltas": f"{table}_deltas_{version}"}


def offset_deltas_name(table: str, start_offset: int) -> str:
    """Deltas table named after the first replayed offset."""
    return f"{table}_{start_offset}_deltas"


def write_version(
    df: DataFrame,
    table: str,
    version: str,
    path: str | None = None,
    partition_cols: tuple[str, ...] | list[str] = (),
) -> str:
    """K4/K8: create the version table ``<table>_<version>`` and fill it; fails if it exists.

    With ``path`` the table is external (its files live there).
    """
    name = version_names(table, version)["version"]
    w = _writer(clustered(df, partition_cols), partition_cols, "errorifexists", dynamic=False)
    if path:
        w = w.option("path", path)
    w.saveAsTable(name)
    return name


def create_table(
    spark: SparkSession,
    name: str,
    schema,
    path: str | None = None,
    partition_cols: tuple[str, ...] | list[str] = (),
) -> None:
    """K8: an empty Parquet table with ``schema``, partitioned by ``partition_cols``.

    Partition columns are declared once, as ordinary columns of the schema, and
    end up last in the table.  With ``path`` the table is external.
    """
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_cols)})" if partition_cols else ""
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet{parts}{location}")


def create_like(spark: SparkSession, new_table: str, template: str, path: str | None = None) -> None:
    """K7: an empty Parquet table shaped like ``template`` (partition columns kept), if absent."""
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {new_table} LIKE {template} USING parquet{location}")


def table_columns(spark: SparkSession, table: str) -> DataFrame:
    """K9: a table's columns as rows: name, data_type, ordinal (1-based), is_partition."""
    cols = spark.catalog.listColumns(table)
    rows = [(c.name, c.dataType, i + 1, bool(c.isPartition)) for i, c in enumerate(cols)]
    return spark.createDataFrame(rows, "name string, data_type string, ordinal int, is_partition boolean")


def frame_columns(df: DataFrame) -> DataFrame:
    """K9 for an unregistered DataFrame: name, data_type, ordinal (1-based), is_partition."""
    rows = [(f.name, f.dataType.simpleString(), i + 1, False) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "name string, data_type string, ordinal int, is_partition boolean")


# --- delimited text ---------------------------------------------------------------

def write_delimited(df: DataFrame, path: str, sep: str = DELIMITER, mode: str = "errorifexists", quoted: bool = False) -> None:
    """K5: delimited text, one line per record: backslash escapes, ``\\N`` for NULL, no quotes.

    With ``quoted`` a CSV form instead: every field in quotes, newlines kept (files then do not split,
    and an empty text reads back as NULL).
    """
    if quoted:
        df.write.mode(mode).options(**{**CSV_OPTIONS, "sep": sep}).option("quoteAll", "true").csv(path)
        return
    df.select(escaped_line(df.schema, sep).alias("value")).write.mode(mode).text(path)
