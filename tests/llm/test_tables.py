from types import SimpleNamespace

import pytest

from strata.llm.tables import shared_folder


def session(master, folder):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda _: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: folder), sparkContext=context)


@pytest.mark.parametrize("master", ["local-cluster[3,2,1024]", "yarn", "spark://host:1"])
def test_sessions_of_several_machines_must_name_the_shared_folder(master):
    with pytest.raises(ValueError):
        shared_folder(session(master, None))
    assert shared_folder(session(master, "file:///shared/")) == "file:///shared"


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_a_local_session_has_a_folder_of_its_own(master):
    assert "llm-shared-" in shared_folder(session(master, None))
