import os

import pytest


@pytest.fixture(scope="session", autouse=True)
def quiet_tokenizers():
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
