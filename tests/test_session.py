from types import SimpleNamespace

import pytest

from eddyflow.session import checkpoint_root, shared_path
from eddyflow.storage import exists, folder_names, is_file
from eddyflow.streaming import stream_lines


def _session(master, conf=None):
    return SimpleNamespace(sparkContext=SimpleNamespace(
        master=master, getConf=lambda: SimpleNamespace(get=lambda k, d=None: conf), getCheckpointDir=lambda: None,
        setCheckpointDir=lambda d: None))


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(_session(master))
    assert checkpoint_root(_session(master, "hdfs:///shared/")) == "hdfs:///shared"


@pytest.mark.parametrize("master", ["local", "local[*]", "local[4]"])
def test_a_local_session_gets_one_of_its_own(master):
    assert checkpoint_root(_session(master)).startswith("/")


def test_storage(spark):
    path = shared_path(spark, "t")
    assert not exists(spark, path) and folder_names(spark, path) == []
    spark.range(3).write.parquet(f"{path}/a")
    assert folder_names(spark, path) == ["a"] and not is_file(spark, path)


def test_staging_computes_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def mark(n):
        seen.add(1)
        return str(n)

    from pyspark.sql import functions as F
    df = spark.range(40).select(F.udf(mark, "string")("id").alias("value")).repartition(3)
    stream_lines(spark, df, shared_path(spark, "t"))
    assert seen.value == 40
