import os
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pytest

from daybook.settings import setting
from daybook.workspace import SETTING, scratch_folder


def session(master, folder=None):
    held = {SETTING: folder} if folder else {}
    conf = SimpleNamespace(get=held.get, set=held.__setitem__)
    context = SimpleNamespace(master=master, applicationId=f"app-{master}-{folder}")
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_the_folder_the_cluster_names():
    cluster = session("yarn", "hdfs:///shared/")
    first, second = (scratch_folder(cluster, "table") for _ in range(2))
    assert first.startswith("hdfs:///shared/table-") and first != second


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match=SETTING):
        scratch_folder(session("yarn"), "table")


def test_a_local_session_keeps_its_folder():
    local = session("local[2]")
    roots = {scratch_folder(local, "table").rsplit("/", 1)[0] for _ in range(2)}
    assert len(roots) == 1


ALONE = """
import os, sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
from daybook.workspace import clear_scratch, scratch_folder
spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
         .config("spark.sql.warehouse.dir", {warehouse!r}).getOrCreate())
first, second = (scratch_folder(spark, "t") for _ in range(2))
assert os.path.dirname(first) == os.path.dirname(second) and first != second
for path in (first, first + "_ledger"):
    spark.range(3).write.parquet(path)
assert spark.read.parquet(first).count() == 3
clear_scratch(spark)
assert not os.path.exists(os.path.dirname(first))
clear_scratch(spark)
"""


def test_a_real_session_without_the_setting(tmp_path):
    repo = str(Path(__file__).resolve().parents[1])
    code = ALONE.format(repo=repo, warehouse=str(tmp_path))
    env = {**os.environ, "TMPDIR": str(tmp_path), "SPARK_CONF_DIR": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", code], env=env, cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]


def test_settings_are_put_back(spark):
    name = "spark.sql.files.maxPartitionNum"
    with pytest.raises(RuntimeError), setting(spark, name, "3"):
        assert spark.conf.get(name) == "3"
        raise RuntimeError
    assert spark.conf.get(name, None) is None
    spark.conf.set(name, "5")
    with setting(spark, name, "3"):
        pass
    assert spark.conf.get(name) == "5"
    spark.conf.unset(name)
