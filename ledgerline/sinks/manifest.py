"""A committed view of an ingest: data in folders of their own, shown by one small record per batch.

Layout under a sink::

    data/app=<sha1 of the name>/batch_id=<n>/attempt=<k>/mon=/day=/hour=/   rows, with a column appname
    _commits/app=<sha1 of the name>/batch_id=<n>/                            a record per committed attempt

Every attempt at a batch writes to a new folder.  Once its rows are there, one record that names its
files and offsets is added; it is a single file that its writer puts in place by a rename, so it is there
or not.  A reader takes the newest record of each batch and reads the files it names: a batch that is being
written, was left half-written or is rewritten by a retry is seen as it was, whole, until the new record
stands.  No catalog partitions are needed, and app names are only hashed into paths.

Files of older attempts stay for readers that began before, until :func:`drop_superseded`.

**Compaction** goes by size: batches, and generations made of batches, fall into tiers by their bytes, each
``FANOUT`` times the one before; ``FANOUT`` or more of a tier are written together as one generation, under
``generations/gen=<id>/``, and shown by one record that tells the batches (and their attempts) that it
covers and the generations that it replaces.  So a pass reads what came since the last one, and every row
is rewritten about once per tier.  A reader takes the generations that nothing replaces, and the batches
that none covers; if a covered batch was rewritten since, its rows in the generation no longer count.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.offsets import OFFSET_LOG_COLUMNS
from ledgerline.schemas import PARTITION_FIELDS
from ledgerline.session import path_exists

RECORD = {  # column -> type
    "appname": "string", "attempt": "long", "folder": "string", "files": "array<string>", "rows": "long", "bad_rows": "long",
    "offsets": "array<struct<topic: string, partition: int, batch_ts: long, start_offset: long, end_offset: long>>",
}
RECORD_DDL = ", ".join(f"{c} {t}" for c, t in RECORD.items())
KEYED_DDL = f"app string, batch_id long, {RECORD_DDL}"
GENERATION_DDL = (
    "gen string, files array<string>, bytes long, covers array<struct<app: string, batch_id: long, attempt: long>>, replaces array<string>"
)
FANOUT = 4  # entries of a tier that are packed together
SMALLEST_TIER = 64 << 20  # bytes of an entry of the first tier
MANY_FILES = 100_000  # named files up to which a reader lists them; beyond it, compact the batches first


def app_key(appname: str) -> str:
    return hashlib.sha1(appname.encode()).hexdigest()


def _commits(sink: str) -> str:
    return f"{sink.rstrip('/')}/_commits"


def _data(sink: str) -> str:
    return f"{sink.rstrip('/')}/data"


def new_attempt(sink: str, appname: str, batch_id: int) -> str:
    """A folder that no other attempt uses."""
    return f"{_data(sink)}/app={app_key(appname)}/batch_id={int(batch_id)}/attempt={uuid.uuid4().hex}"


def commit_batch(
    spark: SparkSession,
    sink: str,
    appname: str,
    batch_id: int,
    folder: str,
    offsets: Iterable[tuple[str, int, int, int, int]],
    rows: int | None = None,
    bad_rows: int | None = None,
) -> None:
    """Show the rows in ``folder`` (from :func:`new_attempt`) as the batch, in place of an earlier attempt.

    ``offsets``: (topic, partition, batch_ts, start_offset, end_offset).  The record is the last thing
    written; until then readers see what was there before.
    """
    files = sorted(spark.read.schema("x int").parquet(folder).inputFiles()) if path_exists(spark, folder) else []
    own = f"{_commits(sink)}/app={app_key(appname)}/batch_id={int(batch_id)}"
    last = spark.read.schema(RECORD_DDL).json(own).agg(F.max("attempt")).first()[0] if path_exists(spark, own) else None
    relative = [f[f.index("/data/app=") + 1 :] for f in files]
    record = (appname, 1 + (last or 0), folder[len(sink.rstrip("/")) + 1 :], relative, rows, bad_rows, [tuple(o) for o in offsets])
    spark.createDataFrame([record], RECORD_DDL).coalesce(1).write.mode("append").json(own)


def committed_batches(spark: SparkSession, sink: str, all_attempts: bool = False) -> DataFrame:
    """app, batch_id and the record of every committed batch: its newest attempt (or all attempts)."""
    if not path_exists(spark, _commits(sink)):
        return spark.createDataFrame([], KEYED_DDL)
    records = spark.read.schema(KEYED_DDL).json(_commits(sink))
    if all_attempts:
        return records
    whole = F.struct(*RECORD)
    newest = records.groupBy("app", "batch_id").agg(F.max_by(whole, "attempt").alias("r"))
    return newest.select("app", "batch_id", "r.*")


def committed_offsets(spark: SparkSession, sink: str) -> DataFrame:
    """The offset log (OFFSET_LOG columns) as the committed batches tell it."""
    each = committed_batches(spark, sink).select("appname", "batch_id", F.explode("offsets").alias("o"))
    return each.select("appname", "o.topic", "o.partition", "batch_id", "o.batch_ts", "o.start_offset", "o.end_offset").select(*OFFSET_LOG_COLUMNS)


def _generations(sink: str) -> str:
    return f"{sink.rstrip('/')}/generations"


def generations(spark: SparkSession, sink: str) -> DataFrame:
    """The records of the generations that no later one replaces: gen, files, bytes, covers, replaces."""
    place = f"{sink.rstrip('/')}/_generations"
    if not path_exists(spark, place):
        return spark.createDataFrame([], GENERATION_DDL)
    every = spark.read.schema(GENERATION_DDL).json(place)
    return every.join(every.select(F.explode("replaces").alias("gen")), "gen", "left_anti")


def _state(spark: SparkSession, sink: str, batches: Column | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Batches that no generation covers, live generations, and covered batches that were rewritten."""
    records = committed_batches(spark, sink)
    if batches is not None:
        records = records.filter(batches)
    live = generations(spark, sink)
    covered = live.select(F.explode("covers").alias("c")).select("c.*")
    current = ["app", "batch_id", "attempt"]
    stale = covered.join(committed_batches(spark, sink).select(*current), current, "left_anti").select("app", "batch_id")
    return records.join(covered, current, "left_anti"), live, stale


def _named(rows: DataFrame) -> list[str]:
    named = [r[0] for r in rows.select(F.explode("files")).limit(MANY_FILES + 1).collect()]
    if len(named) > MANY_FILES:
        raise ValueError(f"more than {MANY_FILES} files; read fewer batches at a time (batches=...) or compact them")
    return named


def _full(schema: T.StructType) -> T.StructType:
    data = [f for f in schema.fields if f.name not in ("appname", "batch_id")]
    return T.StructType([*data, T.StructField("appname", T.StringType()), T.StructField("batch_id", T.LongType())])


def _read_files(spark: SparkSession, sink: str, base: str, files: list[str], full: T.StructType) -> DataFrame:
    found = spark.read.schema(full).option("basePath", base).parquet(*[f"{sink.rstrip('/')}/{f}" for f in files])
    return found.select(*full.names)


def read_committed(spark: SparkSession, sink: str, schema: T.StructType, batches: Column | None = None) -> DataFrame:
    """The rows of the committed batches, as they were when this was called: ``schema`` (the ingested
    columns and the time columns), ``appname`` and ``batch_id``.

    ``batches``, a condition on ``appname`` and ``batch_id``, picks batches before any of their files is
    listed.  What is read is the files that the records name, so a batch committed later does not show in
    this DataFrame, and one rewritten meanwhile shows as it was.
    """
    full = _full(schema)
    loose, live, stale = _state(spark, sink, batches)
    rows = spark.createDataFrame([], full)
    if files := _named(loose):
        rows = _read_files(spark, sink, _data(sink), files, full)
    if files := _named(live):
        packed = _read_files(spark, sink, _generations(sink), files, full)
        packed = packed if batches is None else packed.filter(batches)
        if gone := [tuple(r) for r in stale.collect()]:  # batches rewritten since they were packed
            old = spark.createDataFrame(gone, "app string, batch_id long")
            packed = packed.withColumn("app", F.sha1(F.col("appname").cast("binary"))).join(F.broadcast(old), ["app", "batch_id"], "left_anti")
        rows = rows.unionByName(packed.select(*full.names))
    return rows


def _bytes(spark: SparkSession, sink: str, files: list[str]) -> int:
    total = 0
    for f in files:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{sink.rstrip('/')}/{f}")
        total += place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).getLen()
    return total


def tier_of(size: int, smallest: int, fanout: int) -> int:
    """0 up to ``smallest`` bytes, then one more for each factor of ``fanout``."""
    tier = 0
    while size > smallest:
        size, tier = size / fanout, tier + 1
    return tier


def compact_committed(
    spark: SparkSession,
    sink: str,
    schema: T.StructType,
    partition_cols: tuple[str, ...] | list[str] = PARTITION_FIELDS,
    fanout: int = FANOUT,
    smallest: int = SMALLEST_TIER,
) -> list[str]:
    """One pass of size-tiered compaction over a committed sink; returns the generations made.

    A pass reads the batches and generations of tiers that hold ``fanout`` or more, and nothing else.  One
    compaction of a sink at a time; ingest may go on meanwhile.
    """
    loose, live, stale = _state(spark, sink, None)
    if not stale.isEmpty():  # generations with rows that no longer count are packed anew, without them
        gone = {tuple(r) for r in stale.collect()}
    else:
        gone = set()
    tiers: dict[int, list[dict]] = {}
    for r in loose.filter(F.size("files") > 0).select("app", "batch_id", "attempt", "files").collect():  # since the last pass
        size = _bytes(spark, sink, r["files"])
        tiers.setdefault(tier_of(size, smallest, fanout), []).append({"files": r["files"], "size": size, "covers": [(r["app"], r["batch_id"], r["attempt"])], "gen": None})
    for r in live.collect():
        covers = [(c["app"], c["batch_id"], c["attempt"]) for c in r["covers"]]
        tiers.setdefault(tier_of(r["bytes"], smallest, fanout), []).append({"files": r["files"], "size": r["bytes"], "covers": covers, "gen": r["gen"]})
    made = []
    for tier in sorted(tiers):
        held = tiers[tier]
        if len(held) < fanout:
            continue
        entry = _pack(spark, sink, _full(schema), held, gone, list(partition_cols))
        made.append(entry["gen"])
        up = tier_of(entry["size"], smallest, fanout)
        if up > tier:  # a later tier of this pass may take it along
            tiers.setdefault(up, []).append(entry)
    return made


def _pack(spark: SparkSession, sink: str, full: T.StructType, held: list[dict], gone: set, partition_cols: list[str]) -> dict:
    """Write the entries of a tier as one generation, then its record."""
    gen = uuid.uuid4().hex
    loose = [f for e in held if e["gen"] is None for f in e["files"]]
    packed = [f for e in held if e["gen"] is not None for f in e["files"]]
    parts = []
    if loose:
        parts.append(_read_files(spark, sink, _data(sink), loose, full))
    if packed:
        rows = _read_files(spark, sink, _generations(sink), packed, full)
        if gone:
            old = spark.createDataFrame(sorted(gone), "app string, batch_id long")
            rows = rows.withColumn("app", F.sha1(F.col("appname").cast("binary"))).join(F.broadcast(old), ["app", "batch_id"], "left_anti").select(*full.names)
        parts.append(rows)
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    folder = f"{_generations(sink)}/gen={gen}"
    rows.hint("rebalance", *partition_cols).write.partitionBy(*partition_cols).parquet(folder)
    files = [f[f.index("/generations/gen=") + 1 :] for f in sorted(spark.read.schema("x int").parquet(folder).inputFiles())]
    size = _bytes(spark, sink, files)
    covers = [c for e in held for c in e["covers"] if e["gen"] is None or (c[0], c[1]) not in gone]
    replaces = [e["gen"] for e in held if e["gen"] is not None]
    record = spark.createDataFrame([(gen, files, size, covers, replaces)], GENERATION_DDL)
    record.coalesce(1).write.mode("append").json(f"{sink.rstrip('/')}/_generations")
    return {"files": files, "size": size, "covers": covers, "gen": gen}


def drop_superseded(spark: SparkSession, sink: str) -> int:
    """Delete the data of attempts that a newer attempt has replaced; returns how many.  For when no
    reader of theirs is left."""
    every = committed_batches(spark, sink, all_attempts=True)
    kept = committed_batches(spark, sink).select("folder")
    old = [r["folder"] for r in every.join(kept, "folder", "left_anti").select("folder").distinct().collect()]  # retried batches only
    for folder in old:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{sink.rstrip('/')}/{folder}")
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return len(old)

