from __future__ import annotations

import os
from types import SimpleNamespace

import pytest

from martloom.sinks.scratch import scratch_folder, staged
from tests.frames import same_rows


def session(**settings):
    named = {name.replace("__", "."): value for name, value in settings.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: named.get(name, default)))


def test_shared_folder_is_used(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert one.startswith(f"{shared}/x-") and one != two and not os.path.exists(one)


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]", ""])
def test_cluster_needs_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(session(spark__master=master), "x")
    folder = scratch_folder(
        session(spark__master=master, spark__checkpoint__dir="hdfs://shared/tmp/"), "x"
    )
    assert folder.startswith("hdfs://shared/tmp/x-")


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_local_mode_may_do_without(master):
    folder = scratch_folder(session(spark__master=master), "x")
    assert os.path.isdir(os.path.dirname(folder)) and not os.path.exists(folder)


def test_staged_rows_are_read_back(spark):
    df = spark.range(10).selectExpr("id AS `a.b`", "NULL AS void_like").drop("void_like")
    kept = staged(df, "test")
    assert "FileScan" in kept._jdf.queryExecution().executedPlan().toString()
    same_rows(kept, df)
