import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tests.sparksession import local_spark  # noqa: E402
from tidewick.session import prepare_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return prepare_session(local_spark())
