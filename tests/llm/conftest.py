import pytest

from spanflow.llm import common


@pytest.fixture(scope="session", autouse=True)
def stages(tmp_path_factory):
    """A shared folder of the tests' own; the local session has none."""
    path = str(tmp_path_factory.mktemp("stages"))
    real, common.shared_dir = common.shared_dir, lambda spark: path
    yield
    common.shared_dir = real
