"""The shared work folder."""

import os
from types import SimpleNamespace

import pytest

from brightloom import session


def fake(**settings):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, default=None: settings.get(k, default)))


def test_shared_folder_is_the_configured_one():
    assert session.shared_dir(fake(**{"spark.checkpoint.dir": "s3a://bucket/x", "spark.master": "yarn"})) == "s3a://bucket/x"


def test_cluster_without_shared_folder_is_an_error():
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]", ""):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_dir(fake(**{"spark.master": master}))


def test_local_session_falls_back_and_releases(spark):
    before = session.shared_dir(spark)
    assert os.path.isdir(before.removeprefix("file:")) and session.shared_dir(spark) == before
    session.release_stages(spark)
    df = session.measured(spark.range(10))
    assert df.count() == 10
    path = session._stages[-1]
    assert session.release_stages(spark) == 1 and not os.path.exists(path)
