"""The bucketed layout: same documents, no shuffle by film id."""

from __future__ import annotations

from reelsync.operators.documents import build_documents
from reelsync.sources.fixtures import film_tables
from reelsync.sources.layout import load_bucketed, save_bucketed

from .conftest import SF_SMALL


def test_bucketed_documents_need_no_shuffle(spark):
    t = film_tables(spark, SF_SMALL)
    save_bucketed(t, "layout_test", 4)
    b = load_bucketed(spark, "layout_test")
    docs = build_documents(b)
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    expected = build_documents(t)
    assert docs.exceptAll(expected).count() == 0 and expected.exceptAll(docs).count() == 0
