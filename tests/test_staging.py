"""Where intermediate tables go."""

import os
from types import SimpleNamespace

import pytest

from chaffsieve.sources import staging
from chaffsieve.sources.staging import scratch_root, shared, stage


class Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)

    def set(self, key, value):
        self[key] = value


def session(conf, folder=None):
    """A stand-in for a session, and the checkpoint folder of its context."""
    option = SimpleNamespace(isDefined=lambda: folder is not None, get=lambda: folder)
    context = SimpleNamespace(getCheckpointDir=lambda: option)
    return SimpleNamespace(conf=Conf(conf), _jsc=SimpleNamespace(sc=lambda: context))


def test_the_folder_of_the_cluster_wins():
    spark = session({"spark.checkpoint.dir": "hdfs://x/cp/", "spark.app.id": "a1"}, "hdfs://y")
    assert scratch_root(spark) == "hdfs://x/cp/chaffsieve/a1"
    assert scratch_root(session({"spark.master": "yarn"}, "hdfs://y/c")) == "hdfs://y/c/chaffsieve/session"


def test_only_local_masters_get_a_temporary_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(session({"spark.master": "yarn"}))
    local = session({"spark.master": "local[2]"})
    first = scratch_root(local)
    assert first == scratch_root(local) and os.path.isdir(first.split("/chaffsieve/")[0])


def test_shared_tables_are_built_once_until_released(spark, monkeypatch, tmp_path):
    built = []
    build = lambda: built.append(1) or stage(spark.range(3), "shared")
    first = shared(spark, ("x",), build)
    assert shared(spark, ("x",), build) is first and len(built) == 1
    monkeypatch.setattr(staging, "scratch_root", lambda s: str(tmp_path / "gone"))
    staging.release(spark)
    shared(spark, ("x",), build)
    assert len(built) == 2


def test_staged_tables_keep_names_types_and_rows(spark):
    df = spark.sql("select 1 as a, array('x') as b, cast(null as double) as c")
    kept = stage(df, "sample")
    assert kept.dtypes == df.dtypes and kept.collect() == df.collect()
    path = kept.inputFiles()[0].removeprefix("file://").removeprefix("file:")
    assert scratch_root(spark) in path and os.path.exists(path)


def test_passing_tables_go_when_their_work_is_done(spark):
    from chaffsieve.sources.staging import passing, scratch_root, stage

    def there(path):
        found = spark._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)

    kept = stage(spark.range(3), "kept")
    with passing(spark):
        gone = stage(spark.range(5), "gone")
        assert gone.count() == 5
        [path] = {f.rsplit("/", 1)[0] for f in gone.inputFiles()}
        assert there(path)
    assert not there(path) and there(scratch_root(spark)) and kept.count() == 3
