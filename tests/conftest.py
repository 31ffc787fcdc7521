import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = {s: f"/root/testdata/sf{s}" for s in ("0.001", "0.01", "0.1")}


@pytest.fixture(scope="session")
def event_log(tmp_path_factory):
    return tmp_path_factory.mktemp("events")


@pytest.fixture(scope="session")
def spark(event_log):
    from wardwatch.session import build
    s = build("local[4]", shuffle_partitions=8, app="wardwatch-tests",
              spark__eventLog__enabled="true", spark__eventLog__dir=f"file://{event_log}",
              spark__eventLog__rolling__enabled="false", spark__eventLog__compress="false",
              spark__eventLog__buffer__kb="1k")
    yield s
    s.stop()


@pytest.fixture()
def reads(spark, event_log):
    """reads(make, folder): records that running the frame of ``make()`` reads from
    the events below ``folder``, as the event log counts them."""
    def lines():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        (log,) = event_log.iterdir()
        return log.read_text().splitlines()

    def count(make, folder):
        seen = len(lines())
        make().write.format("noop").mode("overwrite").save()
        events = [json.loads(x) for x in lines()[seen:]]
        scans = set()

        def walk(node):
            if node["nodeName"].startswith("Scan parquet") and f"{folder}/events.parquet" in str(node.get("metadata")):
                scans.update(m["accumulatorId"] for m in node["metrics"] if m["name"] == "number of output rows")
            for child in node["children"]:
                walk(child)

        for e in events:
            if "sparkPlanInfo" in e:
                walk(e["sparkPlanInfo"])
        return sum(int(a["Update"]) for e in events if e["Event"] == "SparkListenerTaskEnd"
                   for a in e["Task Info"]["Accumulables"] if a["ID"] in scans and "Update" in a)

    return count


@pytest.fixture(scope="session")
def tiny():
    return SF["0.001"]


@pytest.fixture(scope="session")
def small():
    return SF["0.01"]
