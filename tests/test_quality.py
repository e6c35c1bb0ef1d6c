import pytest
from pyspark.sql import functions as F

from clickloom.operators import quality
from clickloom.operators.lookup import measure


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [("a", "x", 1), ("a", "y", 2), ("b", None, -1), (None, "x", 0), (None, "z", 0)],
        "id string, kind string, n int",
    )


def test_each_check_reports_exactly_its_violations(spark, rows):
    parents = measure(spark.createDataFrame([("a",), (None,)], "id string"), "id")
    assert [tuple(r) for r in quality.duplicated(rows, "id").collect()] == [("a", 2)]
    assert quality.missing(rows, "id").count() == 2
    assert quality.missing(rows, "id", F.col("kind") != "z").count() == 1
    assert [tuple(r) for r in quality.unaccepted(rows, "kind", ["x", "y"]).collect()] == [("z", 1)]
    assert [tuple(r) for r in quality.orphaned(rows, "id", parents).collect()] == [("b", 1)]
    assert [r["id"] for r in quality.violating(rows, F.col("n") < 0).collect()] == ["b"]


def suite(spark, rows, severity):
    parents = measure(spark.createDataFrame([("a",), ("b",)], "id string"), "id")
    return quality.run_checks(
        [
            (
                rows,
                [
                    quality.not_null("id.not_null", "id", severity=severity),
                    quality.not_null("id.not_null.x", "id", F.col("kind") == "x", severity),
                    quality.RowCheck("n.positive", F.col("n") < 0, severity),
                ],
            )
        ],
        [
            quality.unique("id.unique", rows, "id", severity),
            quality.accepted_values("kind.accepted", rows, "kind", ["x", "y"], severity),
            quality.relationships("id.parent", rows, "id", parents, severity),
        ],
    )


def test_suite(spark, rows):
    results = suite(spark, rows, quality.ERROR)
    got = {r["check"]: (r["failures"], r["passed"]) for r in results.collect()}
    assert got == {
        "id.not_null": (2, False),
        "id.not_null.x": (1, False),
        "n.positive": (1, False),
        "id.unique": (1, False),
        "kind.accepted": (1, False),
        "id.parent": (0, True),
    }
    with pytest.raises(quality.QualityError, match="id.unique: 1 failures"):
        quality.require_passed(results)


def test_warnings_do_not_stop(spark, rows):
    quality.require_passed(suite(spark, rows, quality.WARN))


def test_clean_data_passes(spark):
    clean = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "id string, kind string, n int")
    assert suite(spark, clean, quality.ERROR).where("not passed").count() == 0
    empty = clean.where("false")
    assert suite(spark, empty, quality.ERROR).where("not passed").count() == 0
