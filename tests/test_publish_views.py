from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strata.operators.contracts import enforce_not_null
from strata.operators.quality import quality_payload
from strata.operators.views import is_ready, overview
from strata.sources.commits import Conflict, add_entry, commit, read_log
from strata.sources.snapshot import LOG, Part, covered, current_version, head, publish, publish_snapshot, read_snapshot, vacuum
from strata.sources.storage import add_marker, names
from test_golden_marts import build


def test_quality_payload_and_readiness(spark, landing):
    marts = build(spark, landing)
    payload = quality_payload(marts, city_count=5)
    assert payload["status"] == "pass"
    assert payload["summary"] == {"passed": 9, "failed": 0, "total": 9}
    assert [i["name"] for i in payload["items"]][:2] == ["mart_current_weather_nulls", "mart_daily_summary_nulls"]
    assert is_ready(marts)
    empty = {k: v.limit(0) for k, v in marts.items()}
    assert not is_ready(empty)
    ov = overview(empty).collect()
    assert len(ov) == 1 and ov[0].current_city_count == 0 and ov[0].latest_snapshot_at is None


def test_failed_publish_keeps_previous_version(spark, tmp_path):
    base = str(tmp_path / "mart")
    good = spark.range(3).select(F.col("id").alias("k"))
    v1 = publish_snapshot(spark, {"t": good, "u": good}, base)
    assert current_version(spark, base) == v1
    bad = enforce_not_null(good.select(F.when(F.col("k") == 2, None).otherwise(F.col("k")).alias("k")), ["k"], "u")
    with pytest.raises(PySparkException, match="NOT NULL violated"):
        publish_snapshot(spark, {"t": good, "u": bad}, base)
    assert current_version(spark, base) == v1
    assert read_snapshot(spark, base, "u").count() == 3


def test_publish_derived_table_reads_written_parent(spark, tmp_path):
    base = str(tmp_path / "mart")
    v = publish_snapshot(spark, {"a": spark.range(5), "b": lambda r: r("a").where("id > 2")}, base)
    assert read_snapshot(spark, base, "b", v).count() == 2


def test_versions_accumulate_and_vacuum_keeps_the_newest(spark, tmp_path):
    base = str(tmp_path / "mart")
    assert current_version(spark, base) is None and covered(spark, base) == []
    versions = [publish_snapshot(spark, {"t": spark.range(n)}, base, covers=[f"load{n}"]) for n in range(1, 5)]
    assert len(names(spark, f"{base}/{LOG}")) == 4
    assert vacuum(spark, base, keep=2) == [f"t/in_write={v}" for v in versions[:2]]
    assert vacuum(spark, base, keep=2) == []
    assert current_version(spark, base) == versions[-1]
    assert read_snapshot(spark, base, "t", versions[2]).count() == 3
    assert covered(spark, base) == ["load1", "load2", "load3", "load4"]


def test_crash_before_the_entry_leaves_the_version_before(spark, tmp_path):
    base = str(tmp_path / "mart")
    v1 = publish_snapshot(spark, {"t": spark.range(1)}, base, covers=["a"])

    def refuse(tables):
        raise ValueError(f"{', '.join(tables)} is refused")

    with pytest.raises(ValueError, match="t is refused"):
        publish_snapshot(spark, {"t": spark.range(2)}, base, covers=["b"], check=refuse)
    assert current_version(spark, base) == v1
    assert covered(spark, base) == ["a"]
    assert names(spark, f"{base}/data/t") == [f"in_write={v1}"]


def rows(spark, *ks, tag):
    return spark.createDataFrame([(k, tag) for k in ks], "k int, tag string")


def test_versions_share_the_buckets_that_they_leave(spark, tmp_path):
    base, by_k = str(tmp_path / "mart"), F.col("k") % 4
    odd = {"odd": F.col("k") % 2 == 1}
    one = publish(spark, base, {"t": Part(rows(spark, *range(12), tag="a"), by_k, 4, None, odd)}, None)
    two = publish(spark, base, {"t": Part(rows(spark, 1, 5, tag="b"), by_k, 4, [1, 2], odd)}, one)
    three = publish(spark, base, {}, two, covers=["nothing new"])
    assert two.tables["t"]["parts"] == {"0": one.name, "3": one.name, "1": two.name}  # bucket 2 is empty now
    assert three.tables == two.tables
    assert sorted(map(tuple, read_snapshot(spark, base, "t").collect())) == [(0, "a"), (1, "b"), (3, "a"), (4, "a"), (5, "b"), (7, "a"), (8, "a"), (11, "a")]
    assert one.counters("t") == {"rows": 12, "odd": 6} and two.counters("t") == {"rows": 8, "odd": 5}
    assert read_snapshot(spark, base, "t", one.name).count() == 12
    assert vacuum(spark, base, keep=1) == [f"t/in_write={one.name}/in_bucket=1", f"t/in_write={one.name}/in_bucket=2"]
    assert read_snapshot(spark, base, "t").count() == 8


def test_the_second_publisher_of_a_number_conflicts_and_leaves_nothing(spark, tmp_path):
    base = str(tmp_path / "mart")
    start = publish(spark, base, {"t": Part(rows(spark, 1, tag="a"))}, None)
    first = publish(spark, base, {"t": Part(rows(spark, 2, tag="b"))}, start, covers=["x"])
    with pytest.raises(Conflict):
        publish(spark, base, {"t": Part(rows(spark, 3, tag="c"))}, start, covers=["y"])
    assert current_version(spark, base) == first.name and covered(spark, base) == ["x"]
    assert names(spark, f"{base}/data/t") == [f"in_write={v.name}" for v in (start, first)]
    assert head(spark, base).parent == start.name


def test_an_entry_is_written_once(spark, tmp_path):
    log = str(tmp_path / "log")
    assert read_log(spark, log) == []
    add_entry(spark, log, 1, {"v": 1})
    with pytest.raises(Conflict):
        add_entry(spark, log, 1, {"v": 2})
    with pytest.raises(FileExistsError):
        add_marker(spark, log, "000000001.json", "{}")
    assert read_log(spark, log) == [{"number": 1, "v": 1}]
    assert [n for n in names(spark, log) if not n.endswith(".crc")] == ["000000001.json"]


def test_of_many_writers_at_once_each_gets_a_number_of_its_own(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    log, undone = str(tmp_path / "log"), []
    with ThreadPoolExecutor(6) as pool:
        made = list(pool.map(lambda k: commit(spark, log, lambda entries: ({"k": k, "before": len(entries)}, lambda: undone.append(k))), range(6)))
    entries = read_log(spark, log)
    assert sorted(e["k"] for e in entries) == list(range(6)) and [e["before"] for e in entries] == list(range(6))
    assert sorted(e["number"] for e in made) == list(range(1, 7))
