import pytest
from pyspark.sql import functions as F

from pageloom.operators import ranking
from pageloom.operators.ranking import first_rows
from pageloom.operators.terms import document_frequency


def most_rows_of_a_window(df):
    """The largest number of rows that a task of any window of the plan gets, by running what is below it."""
    plan = df._jdf.queryExecution().optimizedPlan()
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Window":
            found.append(node)
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return len(found)


@pytest.mark.parametrize(("n", "parts", "task_rows"), [(1, 7, 1), (30, 16, 1), (30, 5, 90), (500, 9, 1), (40, 1, 1)])
def test_first_rows(spark, monkeypatch, n, parts, task_rows):
    monkeypatch.setattr(ranking, "TASK_ROWS", task_rows)
    df = spark.range(300).select((F.col("id") % 3).alias("df"), F.format_string("t%03d", (F.col("id") * 7) % 300).alias("term"))
    expected = sorted((r["df"], r["term"]) for r in df.collect())[:n]
    got = first_rows(df, [F.asc("df"), F.asc("term")], n, parts)
    assert sorted(map(tuple, got.collect())) == expected and got.columns == df.columns
    fan, rounds = max(2, task_rows // n), 1
    while parts > 1:
        parts, rounds = -(-parts // fan), rounds + 1
    assert most_rows_of_a_window(got) == rounds
    assert first_rows(df.limit(0), [F.asc("df")], n, 4).count() == 0


def test_all_terms_tie(spark, monkeypatch):
    """Every term in one document only: each round's tasks get two lots of n rows at most, and the lowest terms come out."""
    monkeypatch.setattr(ranking, "TASK_ROWS", 1)
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.transform(F.sequence(F.lit(0), F.lit(9)), lambda k: F.format_string("t%05d", F.col("id") * 10 + k)).alias("terms"))
    for order in ("rarest", "most_frequent"):
        got = document_frequency(docs, 1000, order)
        assert sorted(r["term"] for r in got.collect()) == [f"t{i:05}" for i in range(1000)]
    sizes = []
    first = first_rows

    def watched(df, order, n, parts=None):
        out = first(df, order, n, 8)
        sizes.append(df.count())
        return out

    monkeypatch.setattr("pageloom.operators.terms.first_rows", watched)
    assert document_frequency(docs, 1000, "rarest").count() == 1000 and sizes == [4000]
