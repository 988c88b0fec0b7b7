"""The offset log."""

import json

from pyspark.sql import functions as F

from ledgerline.operators.offsets import (
    batch_counts,
    cells_to_ranges,
    hourly_batches,
    latest_offsets,
    newest_batches,
    offset_cells,
    resolve_range,
    scan_offset_log,
    starting_offsets,
    starting_offsets_json,
)
from ledgerline.plans import events as ev
from ledgerline.schemas import OFFSET_LOG

from tests.support import SF_SMALL

APP = "app"


def _olog(spark, rows):
    return spark.createDataFrame(rows, OFFSET_LOG)


# two partitions, three batches each
ROWS = [
    (APP, "t", 0, 1, 100, 0, 10), (APP, "t", 0, 2, 200, 10, 25), (APP, "t", 0, 3, 300, 25, 30),
    (APP, "t", 1, 1, 110, 0, 4), (APP, "t", 1, 2, 210, 4, 9), (APP, "t", 1, 3, 310, 9, 20),
    ("other", "t", 0, 9, 250, 500, 600),
]


def _ranges(df):
    return {r["partition"]: (r["from_offset"], r["until_offset"]) for r in df.collect()}


def test_covering_and_interior(spark):
    ol = _olog(spark, ROWS)
    assert _ranges(resolve_range(ol, APP, 50, 400, "covering")) == {0: (0, 30), 1: (0, 20)}
    # interior: end of the oldest batch .. start of the newest batch
    assert _ranges(resolve_range(ol, APP, 50, 400, "interior")) == {0: (10, 25), 1: (4, 9)}


def test_begin_excluded_end_included(spark):
    ol = _olog(spark, ROWS)
    assert _ranges(resolve_range(ol, APP, 100, 200, "covering")) == {0: (10, 25), 1: (0, 4)}


def test_one_batch_interior_is_empty_and_no_batch_gives_no_row(spark):
    ol = _olog(spark, ROWS)
    lo, hi = _ranges(resolve_range(ol, APP, 150, 200, "interior"))[0]
    assert hi <= lo
    assert resolve_range(ol, APP, 1000, 2000, "covering").count() == 0


def test_covering_contains_interior(spark):
    ol = ev.hourly_offset_log(ev.events_log(spark, SF_SMALL))
    cov = _ranges(resolve_range(ol, ev.APPNAME, 1704412800, 1705017600, "covering"))
    inn = _ranges(resolve_range(ol, ev.APPNAME, 1704412800, 1705017600, "interior"))
    for p, (lo, hi) in inn.items():
        if lo < hi:
            assert cov[p][0] <= lo and hi <= cov[p][1]


def test_scan_is_pushed_down(spark, scratch):
    path = scratch("olog")
    _olog(spark, ROWS).write.parquet(path)
    plan = scan_offset_log(spark.read.parquet(path), APP, 50, 400)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "batch_ts" in plan


def test_newest_latest_and_starting(spark):
    ol = _olog(spark, ROWS)
    newest = [(r["partition"], r["batch_id"]) for r in newest_batches(ol, APP, 3).collect()]
    assert newest == [(1, 3), (0, 3), (1, 2)]
    latest = {r["partition"]: (r["batch_id"], r["end_offset"]) for r in latest_offsets(ol, APP).collect()}
    assert latest == {0: (3, 30), 1: (3, 20)}
    starts = starting_offsets(ol, APP)
    assert json.loads(starting_offsets_json(starts)) == {"t": {"0": 30, "1": 20}}


def test_cells_round_trip(spark):
    ol = _olog(spark, ROWS)
    cells = offset_cells(ol)
    text = cells.first()["cells"]
    assert text.count("\n") == 1 and '"qualifier":"start"' in text and '"family":"tp_offsets"' in text
    back = {(r["start_offset"], r["end_offset"]) for r in cells_to_ranges(cells).collect()}
    assert back == {(r[5], r[6]) for r in ROWS}
    keys = [r["row"] for r in cells.collect()]
    assert len(set(keys)) == len(keys)  # one key per partition and batch


def test_batch_counts_sum_to_log(spark):
    log = ev.events_log(spark, SF_SMALL)
    counts = batch_counts(hourly_batches(log))
    assert counts.agg(F.sum("message_count")).first()[0] == 1000
    ol = ev.hourly_offset_log(log)
    assert ol.agg(F.sum(F.col("end_offset") - F.col("start_offset"))).first()[0] == 1000
