from types import SimpleNamespace

import pytest

from conftest import rows
from tidegrid import session


def fake(master, **conf):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: conf.get(key.replace(".", "_"), default)),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"))


def test_shared_folder_comes_from_the_session():
    spark = fake("spark://host:7077", spark_checkpoint_dir="hdfs:///work/")
    assert session.shared_root(spark) == "hdfs:///work"
    assert session.new_workspace(spark, "x").startswith("hdfs:///work/x-")


@pytest.mark.parametrize("master", ["yarn", "local[2]", "local-cluster[2,1,1024]"])
def test_without_the_setting_the_folder_lies_below_the_warehouse(master):
    found = session.shared_root(fake(master, spark_sql_warehouse_dir="hdfs:///warehouse/"))
    assert found == "hdfs:///warehouse/_tidegrid"


def test_stored_frames_read_back_and_are_complete(spark):
    path = session.new_workspace(spark, "done")
    assert not session.is_complete(spark, path)
    df = spark.range(5)
    df.write.parquet(path)
    assert session.is_complete(spark, path) and session.stored_bytes(spark, path) > 0
    assert rows(session.materialize(df, "copy")) == [(i,) for i in range(5)]
