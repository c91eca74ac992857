import pandas as pd
import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def tables(spark, tmp_path):
    """Write small tables as a scale folder: ``tables(documents=[...], labels=[...])``."""
    schemas = {
        "documents": DOC_SCHEMA,
        "conversations": "conv_id long, turn long, role string, text string",
        "labels": "doc_id long, quality int, toxic int",
        "pages": "page_id long, url string, html string",
        "benchmark": "item_id long, text string",
        "embeddings": "vec_id long, embedding array<float>, label int",
    }

    def write(**rows):
        for name, data in rows.items():
            spark.createDataFrame(data, schemas[name]).write.mode("overwrite").parquet(
                f"{tmp_path}/{name}.parquet")
        return str(tmp_path)
    return write


@pytest.fixture
def pandas_of():
    return lambda df: pd.DataFrame([r.asDict() for r in df.collect()], columns=df.columns)
