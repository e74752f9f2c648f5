"""A local session for the operators of the training-data subpackage."""

import pytest

from ledgerwatch.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    return local_session("llm-tests", "4", spark__sql__shuffle__partitions="4", spark__checkpoint__dir=f"file://{folder}")
