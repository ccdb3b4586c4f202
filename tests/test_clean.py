import pytest

from tidemark.operators import clean
from tidemark.sources import tables


def _by(df, key, column):
    return {r[key]: r[column] for r in df.collect()}


def test_total_of_new_customers_becomes_zero(edges, roles):
    fixed = _by(clean.fix_total(edges, roles), "customerID", "TotalCharges")
    assert fixed["I"] == 0.0
    assert fixed["J"] is None
    assert fixed["K"] == 3200.0


def test_blank_text_becomes_null(edges, roles):
    assert _by(clean.blank_to_null(edges), "customerID", "TotalCharges")["J"] is None
    assert clean.complete_cases(edges.select("customerID", "TotalCharges")).count() == 3


def test_target_forms(spark):
    text = spark.createDataFrame([("yes",), ("No",), ("YES",), (None,), ("maybe",)], "y string")
    assert [r.y for r in clean.binary_target(text, "y").collect()] == [1, 0, 1, 0, 0]
    with pytest.warns(UserWarning):
        clean.binary_target(text, "y", check=True)
    numbers = spark.createDataFrame([(1,), (0,), (None,)], "y int")
    assert [r.y for r in clean.binary_target(numbers, "y").collect()] == [1, 0, None]
    with pytest.raises(ValueError):
        clean.binary_target(spark.range(1).selectExpr("current_timestamp() AS y"), "y")


def test_validate_target(spark):
    assert clean.validate_target(spark.createDataFrame([(1,), (0,), (None,)], "y int"), "y")
    with pytest.raises(ValueError):
        clean.validate_target(spark.createDataFrame([(1,), (2,)], "y int"), "y")


def test_columns_against_contract(eight):
    assert clean.column_gaps(eight.select("tenure", "Contract"), ["tenure", "Partner"]) == (["Partner"], ["Contract"])
    with pytest.raises(ValueError):
        clean.conform(eight, ["tenure"], strict=True)
    with pytest.raises(ValueError):
        clean.conform(eight, ["tenure", "nothing"], strict=False)
    assert clean.conform(eight, ["Contract", "tenure"], strict=False).columns == ["Contract", "tenure"]


def test_row_violations(edges, roles):
    found = {(r.customerID, r.column_name, r.rule) for r in clean.row_violations(edges, roles).collect()}
    assert ("I", "TotalCharges", "required") in found
    assert ("K", "tenure", "max") in found
    assert ("L", "Contract", "required") in found and ("L", "Contract", "valid") not in found
    assert ("M", "PaymentMethod", "valid") in found
    assert not any(k == "J" and c != "TotalCharges" for k, c, _ in found)


def test_audit_sample_and_union(edges, eight):
    audit = clean.non_numeric_audit(edges, "TotalCharges", "tenure").collect()
    assert {(r.raw_value, r.tenure, r.n) for r in audit} == {(" ", 0, 1), (" ", 5, 1)}
    both = clean.batch_union([eight, edges])
    assert both.count() == 13
    first = clean.sample_complete(both, "customerID", 4)
    again = clean.sample_complete(both.repartition(7), "customerID", 4)
    assert sorted(r.customerID for r in first.collect()) == sorted(r.customerID for r in again.collect())


def test_csv_round_trip(spark, edges, eight, roles, tmp_path):
    both = eight.union(edges)
    path = str(tmp_path / "csv")
    both.coalesce(1).write.option("header", True).option("ignoreTrailingWhiteSpace", False).option(
        "ignoreLeadingWhiteSpace", False
    ).csv(path)
    back = tables.read_customers(spark, path, roles)
    assert back.columns == both.columns
    assert back.schema["tenure"].dataType.simpleString() == "int"
    assert back.schema["TotalCharges"].dataType.simpleString() == "string"
    assert _by(back, "customerID", "TotalCharges")["J"] == " "
    assert back.count() == 13


def test_sinks(spark, eight, tmp_path):
    tables.write_features(eight, str(tmp_path / "f"), ["Contract"])
    assert spark.read.parquet(str(tmp_path / "f")).count() == 8
    for kind in ("json", "csv", "parquet"):
        tables.write_report(eight.select("customerID", "tenure"), str(tmp_path / kind), kind)
        reader = spark.read.option("header", True) if kind == "csv" else spark.read
        assert reader.format(kind).load(str(tmp_path / kind)).count() == 8
