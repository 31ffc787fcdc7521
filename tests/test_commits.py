"""The commit log: racing writers, killed writers, pinned readers, files chosen by time."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from wardwatch.operators import replay
from wardwatch.sources.commits import Change, CommitLog, Conflict

START = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)


def rows(spark, lo, hi, step_minutes=1):
    return spark.createDataFrame([(i, START + dt.timedelta(minutes=i * step_minutes)) for i in range(lo, hi)],
                                 "n long, at timestamp")


def numbers(df):
    return sorted(r["n"] for r in df.collect())


@pytest.fixture()
def log(spark, tmp_path):
    return CommitLog(spark, f"file://{tmp_path}/log")


def test_versions_append_and_replace(spark, log):
    assert log.version() == 0 and log.pin().tables == {}
    assert log.commit({"a": Change(rows(spark, 0, 3)), "b": Change(rows(spark, 0, 1))}) == 1
    assert log.commit({"a": Change(rows(spark, 3, 5), append=True)}) == 2
    assert log.commit({"a": Change(rows(spark, 9, 10))}) == 3
    assert [numbers(log.pin(v).table("a")) for v in (1, 2, 3)] == [[0, 1, 2], [0, 1, 2, 3, 4], [9]]
    assert numbers(log.pin(3).table("b")) == [0]
    with pytest.raises(ValueError, match="other columns"):
        log.commit({"a": Change(spark.range(3), append=True)})
    with pytest.raises(KeyError):
        log.pin().table("c")


def test_a_pinned_reader_sees_one_version_whatever_is_committed(spark, log):
    log.commit({"risk": Change(rows(spark, 0, 2)), "metrics": Change(rows(spark, 0, 2))})
    pinned = log.pin()
    risk = pinned.table("risk")
    log.commit({"risk": Change(rows(spark, 5, 9)), "metrics": Change(rows(spark, 5, 9))})
    assert numbers(risk) == numbers(pinned.table("metrics")) == [0, 1]
    assert numbers(log.pin().table("risk")) == numbers(log.pin().table("metrics")) == [5, 6, 7, 8]


def test_of_two_writers_that_replace_one_fails(spark, log):
    base = log.commit({"risk": Change(rows(spark, 0, 1)), "other": Change(rows(spark, 0, 1))})
    log.commit({"risk": Change(rows(spark, 1, 2))}, base)
    with pytest.raises(Conflict, match="risk"):
        log.commit({"risk": Change(rows(spark, 2, 3)), "other": Change(rows(spark, 2, 3))}, base)
    assert numbers(log.pin().table("risk")) == [1] and numbers(log.pin().table("other")) == [0]
    log.commit({"other": Change(rows(spark, 3, 4))}, base)          # another table: no conflict
    with pytest.raises(Conflict):
        log.commit({"risk": Change(rows(spark, 4, 5), append=True)}, base)     # added to what is gone
    assert numbers(log.pin().table("other")) == [3]


def test_racing_appends_all_count(spark, log):
    log.commit({"a": Change(rows(spark, 0, 1))})
    failed = []

    def write(i):
        try:
            log.commit({"a": Change(rows(spark, i, i + 1), append=True)})
        except Exception as e:
            failed.append(e)

    threads = [threading.Thread(target=write, args=(i,)) for i in range(1, 7)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and log.version() == 7 and numbers(log.pin().table("a")) == list(range(7))


def test_put_happens_once(log):
    assert log._put(1, '{"version": 1, "tables": {}, "wrote": {}}')
    assert not log._put(1, "lost") and log.entry(1)["version"] == 1
    assert log.versions() == [1]


def test_a_killed_writer_leaves_nothing_to_read(spark, log, tmp_path):
    log.commit({"a": Change(rows(spark, 0, 2))})
    log.stage("a", Change(rows(spark, 2, 4), append=True))          # dies before its version
    (tmp_path / "log" / "_log" / ".half").write_text("{")
    assert log.version() == 1 and numbers(log.pin().table("a")) == [0, 1]
    for i in range(3):
        log.commit({"a": Change(rows(spark, i, i + 1))})
    assert log.vacuum(keep=1, grace_seconds=3600) == []             # all parts are young
    assert len(log.vacuum(keep=1, grace_seconds=0)) == 4            # the dead one, and those of older versions
    assert log.versions() == [4] and numbers(log.pin().table("a")) == [2]


def test_recent_rows_come_from_the_files_that_hold_them(spark, log):
    for i in range(4):                                 # four hours, as written by four batches
        log.commit({"vitals": Change(rows(spark, 60 * i, 60 * i + 60).repartition(3), "at", append=True)})
    pinned = log.pin()
    assert pinned.newest("vitals") == START + dt.timedelta(minutes=239)
    since = START + dt.timedelta(minutes=230)
    files = pinned.recent_files("vitals", since)
    every = pinned.zones("vitals").count()
    assert 1 <= len(files) <= 3 and every >= 4
    recent = pinned.recent("vitals", since)
    assert numbers(recent) == list(range(230, 240))
    names = lambda paths: sorted(p.split("/")[-1] for p in paths)
    assert names(recent.inputFiles()) == names(files)               # no other file is opened
    assert numbers(pinned.recent("vitals", START.replace(tzinfo=None))) == list(range(240))
    assert pinned.recent("vitals", START + dt.timedelta(days=2)).count() == 0


def test_late_rows_in_a_new_file_are_found_by_event_time(spark, log):
    """A file written now with old events is left out; an old file with new events is read."""
    log.commit({"vitals": Change(rows(spark, 100, 110), "at")})
    log.commit({"vitals": Change(rows(spark, 0, 5), "at", append=True)})
    assert numbers(log.pin().recent("vitals", START + dt.timedelta(minutes=105))) == list(range(105, 110))
    assert len(log.pin().recent_files("vitals", START + dt.timedelta(minutes=50))) < log.pin().zones("vitals").count()


def test_inventory_and_empty_tables(spark, log):
    assert log.pin().inventory().count() == 0
    log.commit({"a": Change(rows(spark, 0, 7), "at"), "none": Change(rows(spark, 0, 0), "at"), "plain": Change(rows(spark, 0, 2))})
    told = {r["table_name"]: r for r in log.pin().inventory().collect()}
    assert (told["a"]["rows"], told["none"]["rows"], told["plain"]["rows"]) == (7, 0, 2)
    assert told["a"]["files"] >= 1 and told["a"]["bytes"] > 0 and told["plain"]["newest"] is None
    assert told["a"]["newest"] - told["a"]["oldest"] == dt.timedelta(minutes=6)
    assert log.pin().table("none").count() == 0 and log.pin().newest("none") is None


def test_two_exports_at_once_never_mix(spark, log, tiny):
    from wardwatch.plans.catalog import rule_risk
    from wardwatch.plans.layers import Layers
    L = Layers(spark, tiny)
    layers = spark.createDataFrame([("Silver", "vitals")], "layer string, table string")
    args = (L.silver, L.alerts, rule_risk(L), L.patients, layers)
    base = log.version()
    replay.commit_bundle(*args, log, 240, 0.5)
    first = log.pin()
    with pytest.raises(Conflict):
        log.commit({"vitals": Change(L.silver.limit(1)), "patients": Change(L.patients.limit(1))}, base)
    assert log.version() == 1 and log.pin().table("patients").count() == first.table("patients").count()
    span = first.table("vitals").agg(F.min("event_time").alias("lo"), F.max("event_time").alias("hi")).first()
    assert first.table("alerts").filter((F.col("event_time") < span["lo"]) | (F.col("event_time") > span["hi"])).count() == 0
