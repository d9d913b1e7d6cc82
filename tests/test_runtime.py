import os
import subprocess
import sys
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from gavelcast import runtime


def fake_session(master, configured=None, current=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: configured),
        sparkContext=SimpleNamespace(
            master=master, getCheckpointDir=lambda: current, applicationId="app-1"))


def test_shared_folder_comes_from_the_session():
    assert runtime.shared_dir(fake_session("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert runtime.shared_dir(fake_session("yarn", None, "s3a://b/c")) == "s3a://b/c"


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        runtime.shared_dir(fake_session("spark://host:7077"))
    own = runtime.shared_dir(fake_session("local[2]"))
    assert own and own == runtime.shared_dir(fake_session("local[2]"))


def test_a_plain_local_session_can_store(tmp_path):
    """A real session, in its own process, that has no spark.checkpoint.dir."""
    code = (
        "from pyspark.sql import SparkSession\n"
        "from gavelcast import runtime\n"
        "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "assert spark.conf.get('spark.checkpoint.dir', None) is None\n"
        "assert runtime.materialize(spark.range(3), 't').count() == 3\n"
        "print(runtime.shared_dir(spark))\n")
    env = dict(os.environ, SPARK_CONF_DIR=str(tmp_path), PYTHONPATH=os.getcwd())
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-2000:]
    assert not os.path.exists(done.stdout.split()[-1])


def test_materialized_table_is_a_fresh_scan(spark):
    df = spark.range(10).select("id", (F.col("id") % 2).cast("string").alias("part"))
    stored = runtime.materialize(df, "t", "part")
    assert sorted(map(tuple, stored.select("id", "part").collect())) == sorted(map(tuple, df.collect()))
    assert stored.columns == ["id", "part"] and len(stored.inputFiles()) >= 2
    assert runtime.materialize(df.where("false"), "empty").count() == 0


def test_spread_leaves_wide_inputs_alone(spark):
    narrow, wide = spark.range(100, numPartitions=1), spark.range(100, numPartitions=64)
    assert runtime.spread(narrow).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert runtime.spread(wide) is wide


def test_concurrent_steps_keep_their_order_and_errors(spark):
    assert runtime.concurrently(spark, lambda: 1, lambda: spark.range(3).count()) == [1, 3]
    with pytest.raises(ZeroDivisionError):
        runtime.concurrently(spark, lambda: 1 / 0, lambda: 2)


def test_shuffle_files_go_with_the_write_that_made_them(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return sum("shuffle" in str(f) for f in iter_java(files.getAllFiles()))

    def iter_java(seq):
        return [seq.apply(i) for i in range(seq.size())]

    setting = spark.conf.get(runtime.CLEAN_SHUFFLES)
    before = shuffles()
    stored, path = runtime.written_clean(spark.range(1000).repartition(3).groupBy(F.col("id") % 7).count(), "clean")
    for _ in range(50):
        if shuffles() <= before:
            break
        time.sleep(0.1)
    assert shuffles() <= before and stored.count() == 7 and spark.conf.get(runtime.CLEAN_SHUFFLES) == setting
    runtime.discard(spark, path)
