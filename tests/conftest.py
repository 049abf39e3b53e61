import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from speechlens.session import get_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", 8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def plain():
    """Text options without stop words and without stemming."""
    from speechlens.operators.tfidf import TextOptions

    return TextOptions.build(remove_stop_words=False, stemming=False)
