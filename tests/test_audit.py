"""Gaps, repeats and losses of offsets against a plain count of every offset."""

import random

from ledgerline.operators.audit import audit_offsets, is_continuous, log_islands, range_islands
from ledgerline.operators.offsets import carry_forward

RANGES = "appname string, topic string, partition int, batch_id long, batch_ts long, start_offset long, end_offset long"


def _log(spark, rows):
    return spark.createDataFrame(rows, "topic string, partition int, offset long").repartition(5)


def _islands(offsets):
    out = []
    for o in sorted(offsets):
        if out and out[-1][1] == o:
            out[-1][1] = o + 1
        else:
            out.append([o, o + 1])
    return [tuple(x) for x in out]


def _brute(ranges, log):
    out = set()
    for key in {r[:3] for r in ranges}:
        own = [r for r in ranges if r[:3] == key]
        there = {o for t, p, o in log if (t, p) == key[1:]}
        times = {}
        for r in own:
            for o in range(r[5], r[6]):
                times[o] = times.get(o, 0) + 1
        last, every = max(r[6] for r in own), there | set(times)
        kinds = {}
        for o in range(min(every), max(every) + 1) if every else ():
            n = times.get(o, 0)
            for kind, test in (
                ("gap", o in there and not n and o < last), ("repeated", n > 1), ("missing", n and o not in there),
                ("pending", o in there and not n and o >= last), ("absent", not n and o not in there),
            ):
                if test:
                    kinds.setdefault(kind, set()).add(o)
        out |= {(*key, kind, a, b) for kind, os in kinds.items() for a, b in _islands(os)}
    return out


def test_audit_equals_a_count_of_every_offset(spark):
    rnd = random.Random(2)
    for _ in range(4):
        log, ranges = [], []
        for p in range(3):
            log += [("t", p, o) for o in range(rnd.randrange(20), 150) if rnd.random() < 0.9 for _ in range(rnd.choice([1, 1, 2]))]
            for app in ("a", "b"):
                at = rnd.randrange(10)
                for batch in range(8):
                    start = max(0, at + rnd.choice([0, 0, 0, 5, -4]))
                    at = start + rnd.randrange(0, 15)
                    ranges.append((app, "t", p, batch, batch * 10, start, at))
        got = audit_offsets(spark.createDataFrame(ranges, RANGES), _log(spark, log), slice_width=rnd.choice([4, 16, 1000]))
        rows = [tuple(r) for r in got.select("appname", "topic", "partition", "kind", "from_offset", "until_offset").collect()]
        assert len(rows) == len(set(rows)) and set(rows) == _brute(ranges, log)


def test_a_clean_ingest_is_continuous(spark):
    log = _log(spark, [("t", 0, o) for o in range(30)])
    ranges = [("a", "t", 0, 0, 0, 0, 10), ("a", "t", 0, 1, 1, 10, 10), ("a", "t", 0, 2, 2, 10, 25)]
    audit = audit_offsets(spark.createDataFrame(ranges, RANGES), log)
    assert [tuple(r)[3:] for r in audit.collect()] == [("pending", 25, 30)] and is_continuous(audit)
    again = spark.createDataFrame([*ranges, ("a", "t", 0, 3, 3, 24, 26)], RANGES)
    assert not is_continuous(audit_offsets(again, log))


def test_empty_inputs(spark):
    none = spark.createDataFrame([], RANGES)
    assert audit_offsets(none, _log(spark, [("t", 0, 1)])).count() == 0
    one = spark.createDataFrame([("a", "t", 0, 0, 0, 3, 5)], RANGES)
    assert [tuple(r)[3:] for r in audit_offsets(one, _log(spark, [])).collect()] == [("missing", 3, 5)]
    assert log_islands(_log(spark, [])).count() == 0 and range_islands(none).count() == 0 and carry_forward(none).count() == 0


def test_islands(spark):
    log = _log(spark, [("t", 0, o) for o in (0, 1, 2, 2, 5, 6, 7, 8, 9, 30)])
    assert sorted(tuple(r)[2:] for r in log_islands(log, slice_width=4).collect()) == [(0, 3), (5, 10), (30, 31)]
    rows = [("a", "t", 0, i, i, s, e) for i, (s, e) in enumerate([(0, 10), (2, 5), (10, 12), (20, 20), (30, 31), (4, 11)])]
    assert sorted(tuple(r)[3:] for r in range_islands(spark.createDataFrame(rows, RANGES)).collect()) == [(0, 12), (30, 31)]


def test_carry_forward(spark):
    rows = [("a", "t", 0, 1, 10, 0, 5), ("a", "t", 1, 2, 20, 7, 9), ("a", "t", 0, 4, 40, 5, 6), ("b", "t", 0, 3, 30, 0, 1)]
    got = sorted((r["appname"], r["batch_id"], r["partition"], r["batch_ts"], r["start_offset"], r["end_offset"])
                 for r in carry_forward(spark.createDataFrame(rows, RANGES)).collect())
    assert got == [("a", 1, 0, 10, 0, 5), ("a", 2, 0, 20, 5, 5), ("a", 2, 1, 20, 7, 9), ("a", 4, 0, 40, 5, 6), ("a", 4, 1, 40, 9, 9), ("b", 3, 0, 30, 0, 1)]


def test_carry_forward_computes_its_offset_log_once(spark):
    rows = [("a", "t", 0, 1, 100, 0, 5), ("a", "t", 1, 2, 200, 0, 3)]
    plan = carry_forward(spark.createDataFrame(rows, RANGES).where("batch_id * 1234567 > 0"))._jdf.queryExecution().optimizedPlan().toString()
    assert "1234567" not in plan
