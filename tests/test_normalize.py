"""Hand-written raw fixtures for the CSV scan and event normalisation."""

import datetime as dt
import os

from pyspark.sql import functions as F

from eventlens.operators.features import device_features
from eventlens.operators.normalize import normalize_events, normalize_socdem, unique_socdem
from eventlens.operators.product import dau
from eventlens.sources.files import EVENTS_HEADER, newest_file, read_events_csv, read_raw_csv, split_valid

GOOD_TS = "2025-10-06T17:08:06+03:00[Europe/Moscow]"


def _line(ts="", screen="s", feature="f", device="1", session="1", os_="iOS"):
    return ",".join([ts, screen, feature, "", device, session, "v", "m", "t", os_])


def _write(path, lines):
    with open(path, "w", encoding="utf-8") as f:
        f.write(",".join(EVENTS_HEADER) + "\n")
        f.write("\n".join(lines) + "\n")


def test_events_fixture(spark, scratch):
    p = os.path.join(scratch, "events.csv")
    lines = [
        _line(GOOD_TS, device="7"),  # 1 good row
        _line(GOOD_TS, device="7"),  # 2 exact copy
        _line("2025-13-06T17:08:06+03:00[Europe/Moscow]"),  # 3 bad month
        _line(""),  # 4 empty date
        _line("2025", device="8"),  # 5 bare year
        _line("17:08:06", device="8"),  # 5 bare time
        _line("2025-10-06 10:00:00", device="9"),  # 6 no offset: session zone (UTC)
        _line(GOOD_TS, device="  42 "),  # 7 padded device
        _line(GOOD_TS, device="abc"),  # 8 bad device
        _line(GOOD_TS, device=""),  # 8 blank device
        _line(GOOD_TS, device="1.5"),  # 9 decimal device
        _line(GOOD_TS, device="1e3"),  # 9 exponent device
        _line(GOOD_TS, feature="   ", device="10"),  # 10 blank feature
        _line(GOOD_TS, feature="ОПЛАТА ЖКХ", device="11"),  # 11 pay feature
        _line(GOOD_TS, device="12") + ",extra",  # 12 one field too many
        ",".join(_line(GOOD_TS, device="13").split(",")[:-1]),  # 12 one too few
        _line(GOOD_TS, feature='"multi\nline"', device="14"),  # 13 quoted newline
    ]
    _write(p, lines)
    good, bad = read_events_csv(spark, p)
    assert bad.count() == 2

    ev = normalize_events(good)
    rows = {r["device_id"]: r for r in ev.collect()}
    assert set(rows) == {7, 9, 42, 10, 11, 14}
    assert rows[7]["event_ts"] == dt.datetime(2025, 10, 6, 14, 8, 6)  # UTC session: 17:08 +03:00
    assert rows[9]["event_ts"] == dt.datetime(2025, 10, 6, 10, 0, 0)
    assert rows[10]["feature"] is None
    assert rows[14]["feature"] == "multi\nline"
    assert ev.count() == 6  # the exact copy is gone

    keep = normalize_events(good, dedupe=False, require_device=False)
    assert keep.filter(F.col("device_id") == 7).count() == 2
    assert keep.filter(F.col("device_id").isNull()).count() == 4  # abc, blank, 1.5, 1e3

    lenient = normalize_events(good, lenient_ints=True)
    assert {r["device_id"] for r in lenient.collect()} >= {2, 1000}

    feats = {r["device_id"]: r for r in device_features(ev).collect()}
    assert feats[11]["pay_events"] == 1
    assert feats[7]["pay_events"] == 0


def test_day_buckets_follow_zone(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2025, 1, 1, 20, 30), 1), (dt.datetime(2025, 1, 1, 21, 30), 2)],
        "event_ts timestamp, device_id long",
    )
    assert dau(df).count() == 1  # one UTC day
    assert dau(df, tz="Europe/Moscow").count() == 2  # 23:30 and 00:30 in Moscow


def test_socdem_fixture(spark):
    raw = spark.createDataFrame(
        [(" 1 ", " 30 ", " M "), (" 1 ", " 30 ", " M "), ("1", "41", "F"), ("2", "abc", ""), ("x", "20", "F")],
        "number string, age_back string, gender string",
    )
    so = normalize_socdem(raw)
    rows = sorted((r["device_id"], r["age"], r["gender"]) for r in so.collect())
    assert rows == [(1, 30, "M"), (1, 41, "F"), (2, None, None)]
    uniq = {r["device_id"]: (r["age"], r["gender"]) for r in unique_socdem(so).collect()}
    assert uniq == {1: (41, "F"), 2: (None, None)}


def test_quarantine_and_newest(spark, scratch):
    p = os.path.join(scratch, "a.csv")
    _write(p, [_line(GOOD_TS), _line(GOOD_TS) + ",x"])
    good, bad = split_valid(read_raw_csv(spark, p))
    assert good.select(*EVENTS_HEADER).count() == 1
    assert bad.count() == 1
    q = os.path.join(scratch, "b.scv")
    _write(q, [_line(GOOD_TS)])
    os.utime(p, (1_000_000_000, 1_000_000_000))
    assert newest_file(spark, scratch).endswith("b.scv")


def test_build_tables_job(spark, scratch):
    from eventlens.constants import DEFAULT_SOCDEM_FILE
    from eventlens.plans.etl import build_tables

    raw_dir = os.path.join(scratch, "raw")
    os.makedirs(raw_dir)
    _write(os.path.join(raw_dir, "events.csv"), [_line(GOOD_TS, device="1"), _line(GOOD_TS, device="1"), _line("", device="2"), _line(GOOD_TS, device="3") + ",x"])
    with open(os.path.join(raw_dir, DEFAULT_SOCDEM_FILE), "w", encoding="utf-8") as f:
        f.write("number,age_back,gender\n1,30,M\n1,30,M\n,40,F\n")
    # The events source is the newest *.csv in the folder (the socdem file is
    # also a .csv), so the socdem file must be the older one.
    os.utime(os.path.join(raw_dir, DEFAULT_SOCDEM_FILE), (1_000_000_000, 1_000_000_000))
    res = build_tables(spark, os.path.join(scratch, "out"), raw_dir=raw_dir)
    assert (res.raw_rows, res.valid_rows, res.written_rows, res.quarantined_rows) == (3, 2, 1, 1)
    assert res.socdem_rows == 1
    assert spark.read.parquet(res.events_path).first()["device_id"] == 1


def test_churn_on_instant_timestamps(spark):
    from eventlens.operators.features import churn_bounds, churn_dataset, churn_label, device_features

    t0 = dt.datetime(2025, 3, 1, 12, 0, 0)
    rows = [
        (t0, 1, 1, "s", "pay"),                       # device 1: only early → churned
        (t0 + dt.timedelta(days=10), 2, 1, "s", "x"),  # device 2: active in window and after cutoff
        (t0 + dt.timedelta(days=20), 2, 2, "s", "x"),
        (t0 + dt.timedelta(days=30), 3, 1, "s", "x"),  # device 3: defines max_ts
    ]
    ev = spark.createDataFrame(rows, "event_ts timestamp, device_id long, device_session_id long, screen string, feature string")
    labels = {r["device_id"]: r["churn"] for r in churn_label(ev, 14).collect()}
    assert labels == {1: 1, 2: 0, 3: 0}  # cutoff = day 16
    top, cutoff, start = churn_bounds(ev, feature_days=28, label_days=14)
    assert top - cutoff == 14 * 86_400_000_000 and cutoff - start == 28 * 86_400_000_000
    win = {r["device_id"]: r["events_cnt"] for r in device_features(ev, start=start, end=cutoff).collect()}
    assert win == {1: 1, 2: 1}
    so = spark.createDataFrame([(1, 30, "F")], "device_id long, age int, gender string")
    ds = {r["device_id"]: r for r in churn_dataset(ev, so, 28, 14, {"pay": "pay"}).collect()}
    assert set(ds) == {1, 2} and ds[1]["churn"] == 1 and ds[1]["pay_events"] == 1 and ds[2]["age"] is None
