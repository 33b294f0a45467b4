"""Tables of our own in the shared folder."""

import os

import pytest

from siltstone import tables


class _Conf:
    def get(self, key, default=None):
        return None


class _Nowhere:
    """A session on a cluster without a shared folder."""

    class sparkContext:
        master = "spark://host:7077"

        class _jsc:
            @staticmethod
            def sc():
                class Context:
                    @staticmethod
                    def getCheckpointDir():
                        class Option:
                            isDefined = staticmethod(lambda: False)

                        return Option

                return Context

        getConf = staticmethod(_Conf)

    conf = _Conf()


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.shared_folder(_Nowhere(), "x")


def test_written_tables_go(spark):
    rows = spark.range(5).withColumnRenamed("id", "a b")
    held = tables.written(rows, "test")
    assert held.count() == 5 and held.columns == ["a b"]
    path = held.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    path = "/" + path.lstrip("/")
    assert os.path.isdir(path)
    tables.remove(spark, path)
    assert not os.path.exists(path)
