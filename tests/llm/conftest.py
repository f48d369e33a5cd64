import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from odd_rows import ODD  # noqa: E402


@pytest.fixture(scope="session")
def llm(spark):
    from boardweave.llm.ship import ship
    return ship(spark)


@pytest.fixture(scope="session")
def odd(llm):
    """The odd rows with columns whose names operators might use themselves."""
    rows = [(i, t, "xx" if k % 3 else None, "s", len(t or ""), k, "f", True, "k", "r") for k, (i, t) in enumerate(ODD)]
    return llm.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, id long, fingerprint string, clean boolean, key string, row string").repartition(5)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
