"""Each kind of check on rows seeded to fail it, and the suite's size."""

from collections import Counter

from shotmarts.plans import quality as q


def result(df, check):
    row = q.run_checks({"t": df}, [check]).first()
    return row["failures"], row["total"]


def test_checks_find_seeded_rows(spark):
    df = spark.createDataFrame(
        [(1, "W", 0.5), (1, "X", 1.5), (2, None, None), (None, "L", 0.1), (None, "L", 0.1)],
        "id int, label string, share double",
    )
    assert result(df, q.not_null("t", "id")[0]) == (2, 5)
    assert result(df, q.unique("t", "id")) == (1, 3)
    assert result(df, q.unique_combination("t", "id", "label")) == (1, 5)
    assert result(df, q.accepted_values("t", "label", ("W", "L"))) == (1, 5)
    assert result(df, q.expression_true("t", "share", "between 0 and 1")) == (1, 5)
    assert result(df, q.expression_true("t", "share", "< 1", where="id is not null")) == (1, 3)
    assert result(df.where("false"), q.unique("t", "id")) == (0, 0)


def test_row_checks_share_one_pass(spark):
    df = spark.createDataFrame([(1, 2), (None, 3)], "a int, b int")
    results = q.run_checks({"t": df}, [*q.not_null("t", "a", "b"), q.expression_true("t", "b", "> 2")])
    assert [tuple(r)[2:] for r in q.failed(results).collect()] == [("a", 1, 2), ("b", 1, 2)]
    plan = results._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_suite_size():
    assert Counter(c.kind for c in q.SUITE) == {
        q.NOT_NULL: 29, q.UNIQUE: 4, q.UNIQUE_COMBO: 6, q.ACCEPTED: 5, q.EXPRESSION: 18,
    }
