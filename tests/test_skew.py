"""Registered queries on tables in which a third of the rows share a key and some rows are repeated."""

import os

import pytest
from conftest import SMALL
from oracle import TABLES, compare, connect

HOT = {
    "events": """
        SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id) FROM events
        UNION ALL SELECT e.* FROM events e, range(60) WHERE event_id = 7""",
    "documents": """
        SELECT * REPLACE (CASE WHEN doc_id % 3 = 0 THEN 'src1' ELSE source END AS source) FROM documents
        UNION ALL SELECT d.* FROM documents d, range(90) WHERE doc_id = 5""",
    "lineitem": "SELECT * FROM lineitem UNION ALL SELECT l.* FROM lineitem l, range(10) WHERE l_orderkey = 5",
}


@pytest.fixture(scope="module")
def hot_dir(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("hot"))
    con = connect(SMALL)
    for table in TABLES:
        if table in HOT:
            con.execute(f"COPY ({HOT[table]}) TO '{path}/{table}.parquet' (FORMAT parquet)")
        else:
            os.symlink(f"{SMALL}/{table}.parquet", f"{path}/{table}.parquet")
    return path


@pytest.mark.parametrize(
    "name",
    ["sorted_series", "collect_urls", "quota_sample", "shuffle_order", "spot_cost", "idle_last4", "metric_arrays",
     "prefix_bundle", "rename_join", "orphan_pairs", "chunk_verify", "chunk_missing", "page_union", "stream_dedup"],
)
def test_hot_keys_and_copies(spark, hot_dir, name):
    good, found = compare(spark, connect(hot_dir), name, hot_dir)
    assert good, found
