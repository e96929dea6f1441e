"""Physical plans: no plain cross joins, pushed filters, narrow scans, shared storage."""

import re

import pytest
from conftest import SMALL

from opsframe import storage
from opsframe.plans.catalogue import QUERIES

# Scans of these queries need no more columns than listed.
READS = {
    "object_listing": "doc_id:bigint,source:string,n_chars:bigint",
    "price_scan": "ts:timestamp_ntz,user_id:bigint,event_type:string,value:double",
    "fleet_lifetime": "ts:timestamp_ntz,user_id:bigint,event_type:string,value:double",
    "distinct_ids": "user_id:bigint",
    "failure_list": "l_orderkey:bigint,l_returnflag:string",
}


def plan_of(spark, name):
    return QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["spot_cost", "prefix_bundle", "collection_plan", "quota_sample", "collate_runs"])
def test_no_pairs_of_everything(spark, name):
    plan = plan_of(spark, name)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("name", sorted(READS))
def test_scans_are_narrow(spark, name):
    plan = plan_of(spark, name)
    schemas = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan))
    assert schemas == {READS[name]}


def test_filters_reach_the_scan(spark):
    assert "EqualTo(event_type,purchase)" in plan_of(spark, "price_scan")
    assert "EqualTo(lang,en)" in plan_of(spark, "optional_filter")
    assert "IsNotNull(value)" in plan_of(spark, "grid_dedup")


def test_sums_are_formed_before_the_shuffle(spark):
    for name in ("metric_period_avg", "fleet_band", "grid_dedup", "failure_list"):
        plan = plan_of(spark, name)
        assert "partial_" in plan and "SortAggregate" not in plan


def test_column_functions_need_no_python(spark):
    for name in ("key_headers", "url_parts", "manifest_derive", "stop_time", "uuid_map", "line_rewrite"):
        plan = plan_of(spark, name)
        assert "Python" not in plan and "Exchange" not in plan


def test_shared_folder_is_the_one_the_session_names(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    path = storage.scratch_path(spark, "x")
    if configured:
        assert path.startswith(configured.rstrip("/") + "/opsframe/")
        assert spark.sparkContext.applicationId in path
    assert path != storage.scratch_path(spark, "x")


def test_scratch_is_removed_per_application(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "shared_dir", lambda _: str(tmp_path))
    storage.cut_lineage(spark.range(5), "five")
    other = tmp_path / "opsframe" / "another-application"
    other.mkdir()
    assert len(list((tmp_path / "opsframe").iterdir())) == 2
    storage.remove_scratch(spark)
    assert list((tmp_path / "opsframe").iterdir()) == [other]


def test_cluster_without_shared_folder_is_refused(monkeypatch):
    class Context:
        master = "yarn"

    class Conf:
        @staticmethod
        def get(key, default):
            return default

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_dir(Session)
    Context.master = "local[2]"
    assert storage.shared_dir(Session) == storage.shared_dir(Session)


def test_cut_lineage_reads_written_rows(spark):
    cut = storage.cut_lineage(spark.range(5), "five")
    assert cut.count() == 5 and cut.dtypes == spark.range(5).dtypes
    assert "FileScan parquet" in cut._jdf.queryExecution().executedPlan().toString()
