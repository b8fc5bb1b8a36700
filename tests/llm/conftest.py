import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from tributary.llm.shared import importable  # noqa: E402

WORD = re.compile("[^\x20\x09-\x0D]+")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def _workers(spark):
    importable(spark)


@pytest.fixture
def docs(spark):
    def make(rows, schema="doc_id long, text string"):
        return spark.createDataFrame(rows, schema)
    return make


ODD = [None, "", " \n\t ", "one", "word " * 4000, "é ü 中 文 x", "a\nb\nc", "a\nb\nc"]


def odd_rows():
    """Null, empty, blank, very long and repeated texts; a null id; a repeated row."""
    rows = [(i, t) for i, t in enumerate(ODD)]
    return rows + [(None, "no id here at all"), (6, "a\nb\nc")]


def key(row):
    return tuple((x is None, str(x)) for x in row)
