"""Where intermediate tables go."""

import os
from types import SimpleNamespace

import pytest

from temblor import lineage


def fake(master, conf=None, checkpoint=None):
    settings = {"spark.checkpoint.dir": conf} if conf else {}
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default=None: settings.get(name, default)),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint),
    )


def test_the_folder_the_session_names_comes_first():
    assert lineage.shared_folder(fake("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert lineage.shared_folder(fake("yarn", checkpoint="hdfs:///c")) == "hdfs:///c"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        lineage.shared_folder(fake("spark://host:7077"))


def test_a_written_table_reads_back_and_ends_with_its_block(spark):
    df = spark.range(10)
    kept = lineage.materialise(df, "kept")
    assert kept.count() == 10
    assert "FileScan" in kept._jdf.queryExecution().executedPlan().toString()
    with lineage.materialised(df, "short") as table:
        path = table.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path) and table.count() == 10
    assert not os.path.exists(path)
