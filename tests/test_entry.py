import os

import pytest

import __spark_entry__ as E
from tools.oracle_check import compare, duck_con

SF = "/root/testdata/sf0.001"
# A representative subset; FOLIANT_FULL_ORACLE=1 runs every key.
SUBSET = ["tree_paths", "client_files", "tasks_by_format", "pack_batches", "repack_batches", "plan_diff",
          "changed_clients", "apply_changes", "parse_responses", "match_pairs", "consolidate_names",
          "concat_texts", "client_tree", "latest_report", "needs_rescan"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["client", "task_type", "output_format", "n_files", "total_bytes"]
    assert df.count() > 0


def test_registry_complete():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    from foliant.queries import all_queries
    assert set(all_queries()) <= set(s)


KEYS = sorted(E.queries()) if os.environ.get("FOLIANT_FULL_ORACLE") else SUBSET


@pytest.mark.parametrize("key", KEYS)
def test_oracle(spark, key):
    con = duck_con(SF)
    msg, ok = compare(spark, con, key, E.queries()[key], E.oracle_sql().get(key), SF)
    assert ok, msg
