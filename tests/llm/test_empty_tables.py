"""Every registered query over empty tables."""

import pytest

from viewrecon.llm.queries import QUERIES

TABLES = {"documents": "doc_id long, text string, lang string, source string, n_chars long", "labels": "doc_id long, quality int, toxic int", "pages": "page_id long, url string, html string", "embeddings": "vec_id long, embedding array<float>, label int"}


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    for name, schema in TABLES.items():
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty(spark, empty, name):
    out = QUERIES[name](spark, empty)
    assert out.count() == 0 and out.columns
