import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from millrace.contracts import FEATURE_CONTRACT, Column, contract_of, required_columns
from millrace.operators import quality
from frames import rows

NAN = float("nan")
FEATURES = "x_1 double, x_2 double, x_3 double, x_4 double, y double"


@pytest.fixture
def spoiled(spark):
    return spark.createDataFrame([(1.0, NAN, "a"), (None, 2.0, None), (3.0, 4.0, "c")],
                                 "a double, b double, c string")


def test_null_counts(spoiled):
    assert quality.null_counts(spoiled).first().asDict() == {
        "a": 1, "b": 1, "c": 1, "total_rows": 3, "total_nulls": 3}
    assert rows(quality.null_counts_by_column(spoiled, ["b"])) == [("b", 1, 3)]


def test_counts_of_an_empty_table_are_zero(spoiled):
    assert tuple(quality.null_counts(spoiled.limit(0)).first()) == (0, 0, 0, 0, 0)


def test_null_check(spoiled):
    report = quality.null_check(spoiled, ["a", "c"]).first().asDict()
    assert report == {"passed": False, "reason": None, "total_rows": 3, "total_nulls": 2,
                      "nulls_by_column": {"a": 1, "c": 1}, "columns_checked": ["a", "c"]}


def test_empty_table(spoiled):
    empty = spoiled.limit(0)
    strict = quality.null_check(empty, ["a"]).first()
    assert (strict["passed"], strict["reason"]) == (False, quality.EMPTY)
    lenient = quality.null_check(empty, ["a"], fail_on_empty=False).first()
    assert (lenient["passed"], lenient["reason"]) == (True, None)


def test_missing_required_column_is_an_error(spoiled):
    with pytest.raises(AnalysisException, match="nope"):
        quality.null_check(spoiled, ["a", "nope"])


def test_schema_report(spark):
    df = spark.createDataFrame([(1, 2.0, "s", 4.0)], "i int, f float, s string, extra double")
    contract = {"i": Column("float"), "f": Column("float"), "s": Column("string"),
                "gone": Column("int")}
    assert rows(quality.schema_report(df, contract).drop("total_rows", "reason")) == [
        ("extra", None, "double", "extra", False), ("f", "float", "float", "ok", False),
        ("gone", "int", None, "missing", False), ("i", "float", "int", "wrong_type", False),
        ("s", "string", "string", "ok", False)]


@pytest.mark.parametrize("kind, family, good", [
    ("double", "float", True), ("float", "float", True), ("int", "float", False),
    ("decimal(5,2)", "float", False), ("tinyint", "int", True), ("bigint", "int", True),
    ("double", "int", False), ("string", "string", True), ("date", "string", False)])
def test_type_families_are_strict(spark, kind, family, good):
    schema = spark.createDataFrame([], f"c {kind}").schema
    (_, _, _, status), = quality.compare_schema(schema, {"c": Column(family)})
    assert (status == "ok") == good


def test_schema_passes_and_fails_on_empty(spark):
    full = spark.createDataFrame([(1.0,) * 5], FEATURES)
    report = quality.schema_report(full, FEATURE_CONTRACT)
    assert {(row["passed"], row["reason"]) for row in report.collect()} == {(True, None)}
    empty = quality.schema_report(full.limit(0), FEATURE_CONTRACT)
    assert {(row["passed"], row["reason"]) for row in empty.collect()} == {(False, quality.EMPTY)}


def test_require_schema(spark):
    full = spark.createDataFrame([(1.0,) * 5], FEATURES)
    assert quality.require_schema(full, FEATURE_CONTRACT) is full
    with pytest.raises(quality.CheckFailed) as failure:
        quality.require_schema(full.drop("y"), FEATURE_CONTRACT)
    assert failure.value.report["missing_columns"] == ["y"]
    with pytest.raises(quality.CheckFailed, match="empty"):
        quality.require_schema(full.limit(0), FEATURE_CONTRACT)


def test_required_columns():
    assert required_columns(FEATURE_CONTRACT) == ["x_1", "x_2", "x_3", "x_4", "y"]
    assert required_columns({"a": Column("int", nullable=True), "b": Column("int")}) == ["b"]


def test_contract_from_plain_data():
    spec = {"x_1": {"type": "float", "nullable": False}, "n": {"type": "int", "nullable": True},
            "s": {"type": "string"}}
    assert contract_of(spec) == {"x_1": Column("float"), "n": Column("int", nullable=True),
                                 "s": Column("string")}
    with pytest.raises(ValueError, match="date"):
        contract_of({"d": {"type": "date"}})


def test_eager_gate(spoiled):
    assert quality.require(spoiled, quality.null_check(spoiled.limit(0), ["a"], False)) is spoiled
    with pytest.raises(quality.CheckFailed) as failure:
        quality.require(spoiled, quality.null_check(spoiled, ["a"]))
    assert failure.value.report["total_nulls"] == 1
    with pytest.raises(quality.CheckFailed, match="no report"):
        quality.require(spoiled, quality.null_check(spoiled, ["a"]).limit(0))


def test_lazy_gate(spoiled):
    good = spoiled.where("c = 'c'")
    assert quality.gate(spoiled, quality.null_check(good, ["a"])).count() == 3
    assert quality.gate(spoiled, quality.null_check(spoiled, ["a"])).count() == 0
    assert quality.gate(spoiled, quality.null_check(good, ["a"]).limit(0)).count() == 0


def test_gate_is_no_join(spoiled):
    plan = quality.gate(spoiled, quality.null_check(spoiled, ["a"]))
    assert "Join" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_conforms(spark):
    df = spark.createDataFrame([(1.0,)], "a double")
    declared = T.StructType([T.StructField("a", T.DoubleType(), False)])
    assert quality.conforms(df, declared) is df
    with pytest.raises(quality.ContractBroken):
        quality.conforms(df.selectExpr("cast(a as int) a"), declared)
    with pytest.raises(quality.ContractBroken, match="str"):
        quality.conforms("text", declared)


def test_declared_results_are_enforced(spark):
    declared = T.StructType([T.StructField("a", T.DoubleType())])

    @quality.returns(None)
    def says_something():
        return "hello"

    @quality.returns(declared)
    def frame(df):
        return df

    with pytest.raises(quality.ContractBroken, match="declares no result"):
        says_something()
    df = spark.createDataFrame([(1.0,)], "a double")
    assert frame(df) is df
    with pytest.raises(quality.ContractBroken):
        frame(df.withColumnRenamed("a", "b"))
    assert quality.returns(None)(lambda: None)() is None
