"""Attendance: golden values on the 28 sample rows, edge cases, oracle."""

import datetime as dt
import os

import duckdb
import pandas as pd
import pytest

from shelfwise.operators import attendance
from shelfwise.plans.oracle import ATTENDANCE, attendance_selects
from shelfwise.plans.registry import comparable
from shelfwise.sources import csv_io
from shelfwise.sources.schemas import ATTENDANCE_SCHEMA

from .handmade import as_rows

# The sample swipes (employee, action, time), as CSV text.
SAMPLE_CSV = """\
employee_id,action,created_at
E001,In,2025-11-11 08:58:23
E001,Out,2025-11-11 12:45:10
E001,In,2025-11-11 13:30:42
E001,Out,2025-11-11 17:10:05
E002,In,2025-11-11 09:15:33
E002,Out,2025-11-11 12:10:21
E002,In,2025-11-11 13:05:12
E002,Out,2025-11-11 18:02:47
E003,In,2025-11-11 08:50:55
E003,Out,2025-11-11 12:40:18
E003,In,2025-11-11 13:25:40
E003,Out,2025-11-11 17:30:22
E004,In,2025-11-11 10:02:09
E004,Out,2025-11-11 12:55:17
E004,In,2025-11-11 13:40:29
E004,Out,2025-11-11 16:45:11
E005,In,2025-11-11 09:03:44
E005,Out,2025-11-11 12:48:19
E005,In,2025-11-11 13:20:15
E005,Out,2025-11-11 17:02:58
E006,In,2025-11-11 08:40:12
E006,Out,2025-11-11 12:30:45
E006,In,2025-11-11 13:10:33
E006,Out,2025-11-11 17:20:00
E007,In,2025-11-11 09:25:50
E007,Out,2025-11-11 12:55:12
E007,In,2025-11-11 13:35:29
E007,Out,2025-11-11 18:05:41
"""
# Golden values (FIXTURES.md section 2).
HOURS = {"E001": 7.44, "E002": 7.87, "E003": 7.90, "E004": 5.96, "E005": 7.45, "E006": 8.00, "E007": 7.99}
IN_WINDOW = {"E001": 7.24, "E002": 6.83, "E003": 7.24, "E004": 5.96, "E005": 7.41, "E006": 7.34, "E007": 6.90}
START, END = "2025-11-11 09:00:00", "2025-11-11 17:00:00"


def _log(spark, rows):
    return spark.createDataFrame(rows, ATTENDANCE_SCHEMA)


def sample_rows():
    return [(e, a, dt.datetime.fromisoformat(t))
            for e, a, t in (line.split(",") for line in SAMPLE_CSV.splitlines()[1:])]


def test_golden_hours_worked(spark):
    got = {r.employee_id: float(r.total_hours) for r in attendance.hours_worked(_log(spark, sample_rows())).collect()}
    assert got == HOURS


def test_golden_hours_in_window(spark):
    got = {r.employee_id: float(r.hours_in_window)
           for r in attendance.hours_in_window(_log(spark, sample_rows()), START, END).collect()}
    assert got == IN_WINDOW


def test_sorted_log(spark):
    rows = sample_rows()[::-1]
    out = attendance.attendance_log(_log(spark, rows)).collect()
    assert [(r.employee_id, r.created_at) for r in out] == sorted((e, t) for e, _, t in rows)


def edge_rows():
    d = dt.datetime
    return [
        # stray Out first: pairs shift, first stay negative
        ("X1", "Out", d(2025, 1, 1, 7, 0)), ("X1", "In", d(2025, 1, 1, 9, 0)),
        ("X1", "Out", d(2025, 1, 1, 17, 0)), ("X1", "In", d(2025, 1, 2, 9, 0)),
        # 25 h 15 m 15.5 s stay: whole day dropped
        ("X2", "In", d(2025, 1, 1, 8, 0)), ("X2", "Out", d(2025, 1, 2, 9, 15, 15, 500000)),
        # unpaired In only
        ("X3", "In", d(2025, 1, 1, 8, 0)),
        # NULL time and NULL employee
        ("X4", "In", None), ("X4", "Out", d(2025, 1, 1, 12, 0)),
        (None, "In", d(2025, 1, 1, 8, 0)), (None, "Out", d(2025, 1, 1, 9, 0)),
        # sub-second stays (division scales 24 and 28)
        ("X5", "In", d(2025, 1, 1, 8, 0, 0, 0)), ("X5", "Out", d(2025, 1, 1, 8, 0, 0, 300000)),
        ("X5", "In", d(2025, 1, 1, 9, 0, 0, 0)), ("X5", "Out", d(2025, 1, 1, 9, 0, 0, 36)),
        # other actions are ignored
        ("X6", "Break", d(2025, 1, 1, 8, 0)), ("X6", "In", d(2025, 1, 1, 8, 30)),
        ("X6", "Out", d(2025, 1, 1, 10, 0)),
    ]


def duck_attendance(rows, which, start=START, end=END):
    con = duckdb.connect()
    pdf = pd.DataFrame(rows, columns=["employee_id", "action", "created_at"])
    con.register("sw_pd", pdf)
    con.execute("CREATE TABLE swipes AS SELECT employee_id, action, CAST(created_at AS TIMESTAMP) AS created_at FROM sw_pd")
    return con.sql("WITH " + ATTENDANCE + attendance_selects(start, end)[which]).df()


@pytest.mark.parametrize("which", ["hours_worked", "hours_in_window"])
@pytest.mark.parametrize("split", [None, 1])
def test_edge_cases_match_oracle(spark, which, split):
    rows = edge_rows() + sample_rows()
    log = _log(spark, rows)
    kw = {"max_rows_per_segment": split}
    if which == "hours_worked":
        got = attendance.hours_worked(log, **kw)
        want = duck_attendance(rows, which)
    else:
        got = attendance.hours_in_window(log, "2025-01-01 08:30:00", "2025-11-11 17:00:00", **kw)
        want = duck_attendance(rows, which, "2025-01-01 08:30:00", "2025-11-11 17:00:00")
    got = comparable(got).toPandas()
    cols = sorted(want.columns)
    assert as_rows(got, cols) == as_rows(want, cols)


def test_stray_out_and_long_stay(spark):
    got = {r.employee_id: r.total_hours for r in attendance.hours_worked(_log(spark, edge_rows())).collect()}
    # (9:00 - 7:00 next? no) In#1 09:00 with Out#1 07:00 = -2 h; In#2 (2 Jan 09:00) with Out#2 17:00 = -16 h
    assert float(got["X1"]) == -18.0
    # 25:15:15.5 -> 1 + 15/60 + 15.5/3600 = 1.2543 -> 1.25
    assert float(got["X2"]) == 1.25
    assert "X3" not in got and None not in got
    assert got["X4"] is None


def test_golden_hours_from_csv_text(spark, scratch):
    p = os.path.join(scratch, "log.csv")
    with open(p, "w") as f:
        f.write(SAMPLE_CSV)
    log = csv_io.read_attendance(spark, p)
    assert log.count() == 28
    assert {r.employee_id: float(r.total_hours) for r in attendance.hours_worked(log).collect()} == HOURS


def test_pairs_name_their_actions(spark):
    p = attendance.pair_swipes(_log(spark, sample_rows()))
    assert p.columns == ["employee_id", "rn", "in_action", "swipe_in", "out_action", "swipe_out"]
    assert {(r.in_action, r.out_action) for r in p.collect()} == {("In", "Out")}


@pytest.mark.parametrize("split", [None, 3, 50])
def test_many_swipes_without_time(spark, split):
    """A hot employee's swipes without a time, split or not: same pairs, same hours."""
    d = dt.datetime
    rows = sample_rows() + [("H", "In", None)] * 300 + [("H", "Out", None)] * 200 + \
        [("H", "In", d(2025, 11, 11, 8, k)) for k in range(9)] + \
        [("H", "Out", d(2025, 11, 11, 9, k)) for k in range(12)] + [("N", "In", None)] * 60 + \
        [("N", "Out", None)] * 2 + [("O", "Out", None)] * 70
    log = _log(spark, rows)
    pairs = attendance.pair_swipes(log, max_rows_per_segment=split).filter("employee_id in ('H', 'N', 'O')").collect()
    by = {}
    for r in pairs:
        by.setdefault(r.employee_id, []).append(r)
    assert {k: len(v) for k, v in by.items()} == {"H": 212, "N": 2}
    assert sorted(r.rn for r in by["H"]) == list(range(1, 213))
    assert sum(r.swipe_in is not None and r.swipe_out is not None for r in by["H"]) == 9
    got = comparable(attendance.hours_worked(log, max_rows_per_segment=split)).toPandas()
    want = duck_attendance(rows, "hours_worked")
    assert as_rows(got, ["employee_id", "total_hours"]) == as_rows(want, ["employee_id", "total_hours"])
    got = comparable(attendance.hours_in_window(log, START, END, max_rows_per_segment=split)).toPandas()
    want = duck_attendance(rows, "hours_in_window")
    assert as_rows(got, sorted(want.columns)) == as_rows(want, sorted(want.columns))
