"""Data-quality checks and metadata jobs."""

from pyspark.sql import functions as F

from factloom.operators import metadata, quality


def results(df, checks):
    return quality.run_checks(df, checks).orderBy("check_no").collect()


def test_not_null_threshold(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("c",)], "x string")
    loose, strict = results(df, quality.not_null_checks([("x", {"mostly": 0.75}), ("x", {})]))
    assert (loose.element_count, loose.unexpected_count, loose.success_percent, loose.success) == (4, 1, 75.0, True)
    assert not strict.success


def test_in_set_leaves_nulls_out(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    row, = results(df, quality.in_set_checks([("x", {"value_set": ["a", "b"]})]))
    assert (row.element_count, row.unexpected_count, row.success) == (2, 0, True)
    row, = results(df, quality.in_set_checks([("x", {"value_set": ["a"], "mostly": 0.6})]))
    assert (row.success_percent, row.success) == (50.0, False)


def test_tag_examples(spark):
    texts = ['{"Owner":"me"}', '{"Code":"1"}', '{"Code":"1","Owner":""}', None]
    df = spark.createDataFrame([(t,) for t in texts], "tags string")
    kept = df.filter(quality.tag_present(F.col("tags"), "Owner")).collect()
    assert [r.tags for r in kept] == texts[:1]
    row, = results(df, quality.tag_checks([("tags", {"mostly": 0.25})]))
    assert (row.unexpected_count, row.success) == (3, True)


def test_no_rows_succeeds(spark):
    df = spark.createDataFrame([], "x string")
    row, = results(df, quality.not_null_checks([("x", {})]))
    assert (row.element_count, row.success_percent, row.success) == (0, None, True)


def test_unusable_options_are_skipped():
    assert quality.not_null_checks([("x", []), ("", {}), ("y", {"mostly": 1.5}), ("z", {"mostly": 0.5})]) == [
        quality.Check(quality.NOT_NULL, "z", 0.5)
    ]
    assert quality.in_set_checks([("x", {})]) == []


def test_suite_is_one_pass_and_has_a_verdict(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "x string, n int")
    checks = [*quality.not_null_checks([("x", {}), ("n", {})]), *quality.in_set_checks([("n", {"value_set": [1, 2]})])]
    outcome = quality.run_checks(df, checks)
    plan = outcome._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ") == 1
    verdict = quality.suite_verdict(outcome, 60).first()
    assert (verdict.checks, verdict.succeeded, verdict.passed) == (3, 2, True)
    assert not quality.suite_verdict(outcome, 70).first().passed


def test_standard_suites_run(spark):
    df = spark.createDataFrame(
        [("i", "s", "eastasia", "Enabled", None, "t", "n", "p", "Microsoft.CostManagement/query")],
        "id string, subscriptionId string, location string, state string, sku string, tags string, name string, "
        "properties string, type string",
    )
    passed = {
        name: quality.suite_verdict(quality.run_checks(df, suite)).first().passed
        for name, suite in quality.STANDARD_SUITES.items()
    }
    assert passed == {"resources": False, "resource_groups": True, "subscriptions": True, "cost_management": False}


def test_unique_columns_counts_names(spark):
    df = spark.sql("SELECT 1 AS a, 2 AS b, 3 AS A")
    strict, loose = (quality.unique_columns_check(df, strict).first() for strict in (True, False))
    assert (strict.repeated_columns, strict.success, loose.success) == ("a", False, True)
    assert quality.unique_columns_check(spark.sql("SELECT 1 AS a, 2 AS b")).first().success


def test_map_flatten_finds_keys(spark):
    df = spark.createDataFrame([(1, [{"a": "x", "b": "y"}, {"c": "z"}]), (2, [])], "id int, m array<map<string,string>>")
    got = metadata.map_flatten(df, "m")
    assert got.columns == ["id", "a", "b", "c"]
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "x", "y", None), (1, None, None, "z")]
    assert sorted(map(tuple, metadata.map_pairs(df, "m").collect())) == [(1, "a", "x"), (1, "b", "y"), (1, "c", "z")]


def column_rows(spark, fields, *values):
    return spark.createDataFrame(values, ", ".join(f"{f} string" for f in fields))


def test_select_expressions(spark):
    df = column_rows(
        spark, ["ColumnDisplayName", "ColumnTargetName", "SkipColumn"],
        ("a", "[{ColumnTargetName=alpha}]", None), ("b", None, "[{SkipColumn=true}]"),
        ("c", "no equals sign", "[{SkipColumn=false}]"),
    )
    assert metadata.select_expr_list(metadata.column_schema(df)) == ["a as alpha", "c as c"]
    bare = column_rows(spark, ["ColumnDisplayName"], ("x",))
    assert metadata.select_expr_list(metadata.column_schema(bare)) == ["x as x"]


def test_tags(spark):
    df = column_rows(
        spark, ["ColumnDisplayName", "ColumnDescription", "ColumnPersonalData", "ColumnTags"],
        ("a", "[{ColumnDescription=the name, short}]", "[{ColumnPersonalData=yes}]", "[{ColumnTagValue=x}, {ColumnTagValue=y}]"),
        ("b", None, "unset", None),
    )
    tags = metadata.metadata_tags(df)
    assert [tuple(r) for r in tags.collect()] == [("a", "a.ColumnDescription:The Name Short,a.ColumnPersonalData:Yes")]
    assert {tuple(r) for r in metadata.tag_pairs(tags).collect()} == {
        ("a.ColumnDescription", "The Name Short"), ("a.ColumnPersonalData", "Yes"),
    }
