"""Rows and folders that the tests of the text operators share."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
# Texts of every awkward kind: empty, white space only, null, long, ties, odd characters
AWKWARD = ["", None, " \t\n", "a", "Ünïcode ﬁ ǅ ΑΣ İ", "x" * 50_000, "word " * 9_000, "<|endoftext|>a<|startoftext|> <b>&amp;",
           "\x00\x01 null byte", "日本語の文 text 🙂👍🏽", "it's we'll I'd 3.14 --- ###", "a b c　d\x85e\x1cf"]


@pytest.fixture
def awkward(spark):
    """Documents with nulls, repeated rows, and extra columns with clashing names."""
    rows = [(k, t, "x", k) for k, t in enumerate(AWKWARD)]
    rows += [rows[0], rows[5], (None, "null id", None, None), (None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, bucket long")


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, kept string, bucket long")
