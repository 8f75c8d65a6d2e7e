"""Rows that stay of equal texts: the same as the groups say, from one staged table."""

import pytest
from pyspark.sql import functions as F

from millrace.llm import exact_dedup


@pytest.mark.parametrize("normalise", [None, F.lower])
def test_kept_rows_stage_one_row_for_each_text(spark, monkeypatch, normalise):
    data = [(n, f"text {n % 7}", n % 3) for n in range(60)] + [
        (None, "text 1", 0), (None, "alone", 1), (None, "alone", 2), (5, "TEXT 5", 0), (59, "text 3", 9), (59, "text 3", 8),
        (70, None, 0), (71, "", 0), (72, "x" * 40 + "a", 0), (73, "x" * 40 + "b", 0), (72, "x" * 40 + "b", 0)]
    docs = spark.createDataFrame(data, "doc_id long, text string, other int").repartition(5)
    groups = exact_dedup.content_groups(docs, normalise).filter("kept").collect()
    body = (lambda t: (t or "").lower()) if normalise else (lambda t: t or "")
    largest = {}
    for doc_id, text, _ in data:
        largest[body(text)] = max(largest.get(body(text), -1), -1 if doc_id is None else doc_id)
    want = sorted((r for r in data if largest[body(r[1])] == (-1 if r[0] is None else r[0])), key=str)
    made, staged = [], exact_dedup.staged
    monkeypatch.setattr(exact_dedup, "staged", lambda df, name: made.append((name, staged(df, name))) or made[-1][1])
    assert sorted(map(tuple, exact_dedup.kept_rows(docs, normalise).collect()), key=str) == want
    assert [name for name, _ in made] == ["content-kept"] and made[0][1].count() == len(largest) == len(groups)
