"""Where intermediate tables go."""

from types import SimpleNamespace

import pytest

from strataglean.session import shared_root


def session(master, **conf):
    context = SimpleNamespace(master=master, applicationId="app", getCheckpointDir=lambda: None,
                              setCheckpointDir=lambda path: None)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)))


def test_folder_named_by_the_session():
    assert shared_root(session("spark://a:1", **{"spark.checkpoint.dir": "hdfs://b/c/"})) == "hdfs://b/c"


def test_unset_is_an_error_on_a_cluster_only():
    assert shared_root(session("local[2]", **{"spark.sql.warehouse.dir": "/w/"})) == "/w/strataglean-app"
    for master in ("yarn", "spark://a:1", "k8s://a"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_root(session(master, **{"spark.sql.warehouse.dir": "/w"}))
