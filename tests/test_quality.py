import pytest

from lotwise.plans import quality
from lotwise.plans.quality import ACCEPTED, CHECKS, NOT_NULL, RELATIONSHIPS, UNIQUE, Check, CheckFailed


def test_declared_checks():
    kinds = [check.kind for check in CHECKS]
    assert [kinds.count(kind) for kind in (NOT_NULL, UNIQUE, ACCEPTED, RELATIONSHIPS)] == [42, 4, 2, 1]
    assert len(set(CHECKS)) == 49


def test_given_tables_pass(models):
    tables = {check.model: models.table(check.model) for check in CHECKS}
    found = quality.run_checks(tables).collect()
    assert len(found) == 49 and all(row.failures == 0 for row in found)


def test_broken_tables_fail(spark):
    child = spark.createDataFrame([("a",), ("a",), ("x",), ("x",), ("x",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("b",)], "k string")
    checks = [
        Check("child", "k", NOT_NULL),
        Check("child", "k", UNIQUE),
        Check("child", "k", ACCEPTED, values=("a",)),
        Check("child", "k", RELATIONSHIPS, parent="parent", parent_column="k"),
        Check("parent", "k", UNIQUE),
    ]
    found = quality.run_checks({"child": child, "parent": parent}, checks).collect()
    failures = {(r.model, r.check_kind): r.failures for r in found}
    assert failures == {
        ("child", NOT_NULL): 1,
        ("child", UNIQUE): 2,
        ("child", ACCEPTED): 1,
        ("child", RELATIONSHIPS): 3,
        ("parent", UNIQUE): 0,
    }


def test_gate(spark):
    brand = spark.createDataFrame([("b", None)], "brand string, offer_count long")
    with pytest.raises(CheckFailed, match="agg__offers_by_brand: offer_count not_null: 1"):
        quality.require_passing({"agg__offers_by_brand": brand}, "agg__offers_by_brand")
    quality.require_passing({"agg__offers_by_brand": brand.fillna(1)}, "agg__offers_by_brand")
    quality.require_passing({}, "rpt__fuel_type")
