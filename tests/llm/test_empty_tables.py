"""Every query on empty tables, and on tables whose columns are all null."""

import pytest

import corpus_pipeline
from rasterloom.llm import queries

TABLES = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "benchmark": "item_id long, text string",
    "pages": "page_id long, url string, html string",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "conversations": "conv_id long, turn long, role string, text string",
}
ALL = queries.QUERIES | {"pipeline": corpus_pipeline.run}


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    out = {}
    for name, rows in (("empty", 0), ("null", 3)):
        out[name] = tmp_path_factory.mktemp(name)
        for table, schema in TABLES.items():
            spark.createDataFrame([(None,) * (schema.count(",") + 1)] * rows, schema).write.parquet(str(out[name] / f"{table}.parquet"))
    return out


@pytest.mark.parametrize("name", ALL)
def test_empty(spark, folders, name):
    assert ALL[name](spark, str(folders["empty"])).count() == (1 if name == "op5_chat_format" else 0)


#: Rows with all columns null give: a row each for the operators on rows, none for those that report findings.
NULL_ROWS = {"op6_decontamination": 0, "op8_exact_topk": 0, "op5_chat_format": 2, "pipeline": 0}


@pytest.mark.parametrize("name", ALL)
def test_null(spark, folders, name):
    assert ALL[name](spark, str(folders["null"])).count() == NULL_ROWS.get(name, 3)
