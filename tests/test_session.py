"""The shared scratch folder."""

from __future__ import annotations

import pytest

from goldrow import session


class _Conf(dict):
    def set(self, key, value):
        self[key] = value


class _Session:
    def __init__(self, master, **conf):
        self.conf = _Conf(conf)
        self.sparkContext = type("Context", (), {"master": master})


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"])
def test_cluster_without_shared_folder_is_an_error(master):
    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        session.shared_folder(_Session(master))


def test_configured_folder_is_taken():
    made = _Session("yarn", **{"spark.checkpoint.dir": "hdfs:///scratch"})
    assert session.shared_folder(made) == "hdfs:///scratch"


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_local_master_needs_none(master):
    made = _Session(master)
    folder = session.shared_folder(made)
    assert session.shared_folder(made) == folder == made.conf["spark.checkpoint.dir"]
