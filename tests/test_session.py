from __future__ import annotations

from types import SimpleNamespace

import pytest

from skuweave.session import shared_folder


def session(master: str, named: str | None = None, checkpoint: str | None = None) -> SimpleNamespace:
    context = SimpleNamespace(master=master, applicationId="app-1", getCheckpointDir=lambda: checkpoint)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: named or default), sparkContext=context)


def test_the_shared_folder_is_the_named_one():
    assert shared_folder(session("yarn", "hdfs://a/b")) == "hdfs://a/b"
    assert shared_folder(session("yarn", None, "hdfs://c")) == "hdfs://c"
    assert shared_folder(session("local[4]", "file:///d", "hdfs://c")) == "file:///d"


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://host"])
def test_several_machines_need_a_folder(master):
    with pytest.raises(ValueError):
        shared_folder(session(master))


def test_one_machine_gets_a_private_folder():
    assert shared_folder(session("local[*]")) == shared_folder(session("local"))
