from pyspark.sql import functions as F

from stallwise.operators import checks


def test_each_check_finds_its_seeded_row(spark):
    df = spark.createDataFrame(
        [(1, "a", 0.5), (1, "a", None), (2, "x", 1.5), (None, None, 0.1), (None, None, 0.0)], "k int, t string, v double"
    )
    parent = spark.createDataFrame([(1,)], "id int")
    assert [tuple(r) for r in checks.unique(df, ["k"]).collect()] == [(1, 2)]
    assert checks.unique(df, ["k", "t"]).count() == 2  # a combination compares nulls
    assert [tuple(r) for r in checks.not_null(df, ["v"]).collect()] == [("v", 1)]
    assert [tuple(r) for r in checks.accepted_values(df, "t", ["a"]).collect()] == [("x", 1)]
    assert [tuple(r) for r in checks.relationships(df, "k", parent, "id").collect()] == [(2, 1)]
    assert checks.outside_unit_interval(df, "v").count() == 1
    assert checks.outside_unit_interval(df, "v", null_is_bad=True).count() == 2
    assert [tuple(r) for r in checks.equal_rowcount(df, parent).collect()] == [(5, 1)]
    assert checks.equal_rowcount(df, df).count() == 0


def test_totals(spark):
    a = spark.createDataFrame([(1.0000001,)], "x double")
    b = spark.createDataFrame([(1.0,)], "x double")
    c = spark.createDataFrame([(1.1,)], "x double")
    total = F.sum("x")
    assert checks.totals_differ(a, total, b, total).count() == 0
    assert checks.totals_differ(c, total, b, total).count() == 1
    assert checks.totals_differ(b.where("x > 5"), total, b.where("x > 5"), total).count() == 0


def test_suite_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, None)], "k int, t string")
    suite = checks.Suite().unique("d", df, ["k"]).not_null("d", df, ["k", "t"]).accepted_values("d", df, "t", ["b"])
    got = {(r["check_name"], r["columns"]): (r["n_violations"], r["passed"]) for r in suite.summary().collect()}
    assert got == {
        ("unique", "k"): (1, False), ("not_null", "k"): (0, True), ("not_null", "t"): (1, False),
        ("accepted_values", "t"): (1, False),
    }


def test_declared_contract_size():
    from stallwise.plans import quality

    single = [u for u in quality.UNIQUE if len(u[1]) == 1]
    assert len(single) == 20 and len(quality.UNIQUE) - len(single) == 3
    assert sum(map(len, quality.NOT_NULL.values())) == 81
    assert (len(quality.ACCEPTED), len(quality.RELATIONSHIPS)) == (7, 6)
