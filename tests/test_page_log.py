"""Page logs: short pages before the last one, without a window over a scope's pages."""

from __future__ import annotations

from tablewright.operators.lifecycle import check_page_log

ROWS = [("a", 1, "x", "p"), ("a", 2, "y", "p"), ("a", 2, "z", "q"), ("b", 1, "x", "p"), ("b", 1, "y", "p"), ("b", 2, "z", "q"), ("c", None, "x", "p"), ("d", None, "x", "p"), ("d", 1, "y", "q"), ("e", 1, "x", None), ("e", 3, "x", "p")]


def test_short_pages(spark):
    out = check_page_log(spark.createDataFrame(ROWS, "scope string, page int, id string, payload string"), "scope", "page", "id", "payload", page_size=2)
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
    found = {r["scope"]: (r["short_page_contradiction"], r["cross_page_overlap"], r["conflicting_duplicate"]) for r in out.collect()}
    assert found == {"a": (True, False, False), "b": (False, False, False), "c": (None, False, False), "d": (False, False, False), "e": (True, True, False)}
