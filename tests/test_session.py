import os
from types import SimpleNamespace

from annoflow import session


class _Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


def fake(conf, checkpoint=None, application="app"):
    context = SimpleNamespace(getCheckpointDir=lambda: checkpoint, applicationId=application, master="local[2]")
    return SimpleNamespace(conf=_Conf(conf), sparkContext=context)


def test_scratch_follows_the_session():
    assert session.scratch_root(fake({"spark.checkpoint.dir": "hdfs://x/y"})) == "hdfs://x/y"
    assert session.scratch_root(fake({}, "hdfs://set")) == "hdfs://set"
    own = session.scratch_root(fake({}))
    assert own == session.scratch_root(fake({})) != session.scratch_root(fake({}, application="other"))


def test_temporary_tables_are_removed(spark):
    with session.temporary_tables(spark):
        kept = session.written(spark.range(3), "t")
        place = kept.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(place) and kept.count() == 3
    assert not os.path.exists(os.path.dirname(place))
    outside = session.written(spark.range(2), "t")
    assert outside.count() == 2


def test_results_outlive_their_block(spark):
    with session.temporary_tables(spark):
        with session.temporary_tables(spark):
            lost = session.written(spark.range(3), "t")
            kept = session.written(lost, "t", keep=True)
            places = [f.inputFiles()[0].removeprefix("file://") for f in (lost, kept)]
        assert [os.path.exists(p) for p in places] == [False, True] and kept.count() == 3
    assert not os.path.exists(places[1])
