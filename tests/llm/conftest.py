import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def docs(spark):
    """The awkward documents, with nulls, ties, repeated rows and columns of clashing names."""
    import corpus

    return corpus.frame(spark).cache()


@pytest.fixture(scope="session")
def none(spark):
    """An empty table of documents."""
    import corpus

    return corpus.frame(spark, [])
