from __future__ import annotations

import pytest

from measurekit.llm.queries import vocabulary_path

DOCS = "doc_id long, text string, source string"


@pytest.fixture(scope="session")
def vocabulary():
    return vocabulary_path()


@pytest.fixture
def docs(spark):
    def make(texts, start=0):
        return spark.createDataFrame([(start + i, t, "s") for i, t in enumerate(texts)], DOCS)

    return make
