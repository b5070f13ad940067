from types import SimpleNamespace

import pytest

from tillmark import session


def fake(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default=None: folder if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(applicationId=f"app-{master}-{folder}", master=master))


def test_scratch_folder_is_the_named_one():
    assert session.scratch_root(fake("yarn", "hdfs:///shared/")) == "hdfs:///shared/tillmark/app-yarn-hdfs:///shared/"


def test_only_a_local_master_makes_its_own_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_root(fake("spark://host:7077"))
    local = fake("local[2]")
    assert session.scratch_root(local) == session.scratch_root(local)


def test_materialized_tables_read_back(spark):
    df = spark.range(10).selectExpr("id", "cast(null as string) as s", "timestamp_ntz'2024-01-01 00:00:01' as t")
    again = session.materialize(df, "test")
    assert again.schema.simpleString() == df.schema.simpleString()
    assert sorted(again.collect()) == sorted(df.collect())
