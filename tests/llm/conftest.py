from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from eventmart.llm.common import prepare  # noqa: E402


@pytest.fixture
def area(spark):
    made = prepare(spark)
    yield made
    made.drop()


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Documents from texts, or from (doc_id, text) pairs."""

    def make(*texts, lang="en", source="s", extra: str = ""):
        rows = [t if isinstance(t, tuple) else (k, t) for k, t in enumerate(texts)]
        df = spark.createDataFrame([(k, t, lang, source, len(t or "")) for k, t in rows], DOCS)
        return df.selectExpr("*", *([extra] if extra else []))

    return make
