"""Ids that are no numbers are an error where the docstrings ask for numbers, not a wrong result."""

import pytest

from fleetmart.llm import fingerprint, substring, warc


@pytest.mark.parametrize("run", [substring.digests, substring.remove, fingerprint.edited])
def test_text_ids(spark, run):
    words = " ".join(map(str, range(30)))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|DATATYPE_MISMATCH"):
        run(spark.createDataFrame([("a", words), ("b", words)], "doc_id string, text string")).collect()


def test_text_page_ids(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|DATATYPE_MISMATCH"):
        warc.pages(spark, warc.archive(spark.createDataFrame([("a", "u", "<html>")], "page_id string, url string, html string"))).collect()
