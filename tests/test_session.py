from __future__ import annotations

from types import SimpleNamespace

import pytest

from meterlake.session import shared_dir


def session(master: str, folder: str | None):
    return SimpleNamespace(
        conf={"spark.checkpoint.dir": folder},
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
    )


def test_the_session_names_the_shared_folder():
    assert shared_dir(session("yarn", "hdfs:///shared/")) == "hdfs:///shared"


def test_a_local_session_without_one_gets_its_own():
    local = session("local[4]", None)
    assert shared_dir(local) == shared_dir(local)


def test_a_cluster_must_name_one():
    with pytest.raises(ValueError):
        shared_dir(session("spark://host:7077", None))
