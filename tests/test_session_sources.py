"""Session helpers and source binders."""

import pytest

from lumenrec import schemas
from lumenrec.sources.tables import from_catalog


def test_from_catalog_and_schema_check(spark):
    rows = [("s1", "u1", "c1", "g1")]
    spark.createDataFrame(rows, schemas.STUDENT).createOrReplaceTempView("stu_view")
    t = from_catalog(spark, {"student": "stu_view"})
    assert [tuple(r) for r in t.student.collect()] == rows


def test_schema_check_rejects_missing_and_mistyped(spark):
    bad = spark.createDataFrame([("s1", 1)], "stu_id string, stu_uid int")
    with pytest.raises(ValueError, match="missing columns"):
        schemas.check(bad, schemas.STUDENT, "student")
    wrong = spark.createDataFrame([("s1", 1, "c", "g")], "stu_id string, stu_uid int, city_id string, stu_grade_id string")
    with pytest.raises(TypeError, match="stu_uid"):
        schemas.check(wrong, schemas.STUDENT, "student")
