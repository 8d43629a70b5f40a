import os

import pytest

from wardwise import session


def test_tables_are_deleted_but_for_the_kept_one(spark):
    with session.Temporary(spark) as tables:
        inner = session.materialize(spark.range(5), "inner")
        path = inner.inputFiles()[0]
        out = tables.keep(inner.selectExpr("id + 1 AS id"))
        assert os.path.exists(path.removeprefix("file://"))
    assert not os.path.exists(path.removeprefix("file://"))
    assert sorted(r.id for r in out.collect()) == [1, 2, 3, 4, 5]


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())
