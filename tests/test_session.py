"""The scratch folder with and without a configured one."""

import pytest

from offerwell import session


class Conf:
    def __init__(self, base, master):
        self.base, self.master = base, master
        self.conf = self.sparkContext = self

    def get(self, name, default=None):
        return self.base if name == "spark.checkpoint.dir" else default


def test_work_dir_without_a_configured_folder(monkeypatch):
    monkeypatch.setattr(session, "_LOCAL", [])
    one, two = (session.work_dir(Conf(None, "local[2]"), "t") for _ in range(2))
    assert one != two and one.rsplit("/", 1)[0] == two.rsplit("/", 1)[0]
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_dir(Conf(None, "spark://host:7077"), "t")


def test_work_dir_below_the_configured_folder():
    assert session.work_dir(Conf("hdfs:///shared/", "yarn"), "t").startswith("hdfs:///shared/offerwell-t-")


def test_lineage_is_cut_without_a_configured_folder(spark, monkeypatch):
    monkeypatch.setattr(session, "_LOCAL", [])
    real = type(spark.conf).get
    monkeypatch.setattr(type(spark.conf), "get", lambda self, name, *a: None if name == "spark.checkpoint.dir" else real(self, name, *a))
    assert session.cut_lineage(spark.range(5), "t").count() == 5 and session._LOCAL
