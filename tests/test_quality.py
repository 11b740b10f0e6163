from pyspark.sql import functions as F

from stratamart import schemas
from stratamart.functions.columns import row_digest
from stratamart.operators import profile, quality
from tests.conftest import rows


def test_key_and_reference_checks(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,), (None,)], "k int")
    dim = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    assert rows(quality.key_check(dim, "id", "dim")) == [("dim", "id", 3, 0, 1, 1, 2)]
    assert rows(quality.duplicate_keys(dim, "id")) == [(2, 2)]
    assert rows(quality.orphan_keys(fact, "k", dim, "id")) == [(9, 2)]
    assert rows(quality.foreign_key_check(fact, "k", dim, "id", "fact.k")) == [("fact.k", 6, 1, 1, 2)]


def test_checks_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "k int, s string")
    assert rows(quality.key_check(empty, "k", "t")) == [("t", "k", 0, 0, 0, None, None)]
    assert rows(profile.duplicate_profile(empty)) == [(0, 0, 0)]
    assert rows(profile.null_profile(empty)) == [("k", 0, None), ("s", 0, None)]


def test_type_and_width_checks(spark):
    df = spark.createDataFrame([("m" * 15, 150.5), ("m" * 14, 150.0), (None, None)], "model string, engine_hp double")
    assert rows(quality.type_check(df, {"engine_hp": "int"})) == [("engine_hp", "int", 3, 1)]
    assert rows(quality.width_check(df, schemas.WIDTHS)) == [("model", 14, 15, 1)]


def test_reconciliation_and_schema(spark):
    a, b = spark.range(3), spark.range(2)
    assert rows(quality.reconcile({"a": a, "b": b}, "a")) == [("a", 3, 3, True), ("b", 2, 3, False)]
    assert quality.conforms(a, schemas.struct("id long")) == []
    assert quality.conforms(a, schemas.struct("id int, x string")) == ["id", "x"]


def test_profiles(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("a", 1.0), ("b", 4.0), (None, None)], "c string, n double")
    assert rows(profile.shape(df)) == [(5, 2)]
    assert rows(profile.duplicate_profile(df)) == [(5, 3, 2)]
    assert [tuple(r) for r in profile.value_counts(df, "c").collect()] == [("a", 3), ("b", 1)]
    assert rows(profile.category_domain(df, ["c"])) == [("c", "a", 0), ("c", "b", 1)]
    assert rows(profile.distinct_counts(df, ["c"])) == rows(profile.distinct_counts(df, ["c"], approximate=True))
    summary = profile.numeric_profile(df, ["n"]).first()
    assert (summary["count"], summary["mean"], summary["std"], summary["q75"]) == (4, 1.75, 1.5, 1.75)


def test_duplicates_of_long_texts(spark):
    data = [("x" * 65, None), ("x" * 65, None), ("x" * 64, None), (None, 1.0), (None, 1.0), ("", 1.0)]
    df = spark.createDataFrame(data, "`a.b` string, c double")
    assert rows(profile.duplicate_profile(df)) == [(6, 4, 2)]


def test_references_of_several_keys_copy_no_row_per_key(spark):
    fact = spark.createDataFrame([(1, "a"), (1, None), (9, "z"), (9, "z"), (None, "a")], "k int, t string")
    ones, texts = spark.createDataFrame([(1,), (1,), (None,)], "id int"), spark.createDataFrame([("a",)], "id string")
    found = quality.foreign_key_checks(fact, {"k": (ones, "id"), "t": (texts, "id")}, "fact")
    assert rows(found) == [("fact.k", 5, 1, 1, 2), ("fact.t", 5, 1, 1, 2)]
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in found.inputFiles() if "key_counts" in f]


def test_duplicates_are_grouped_by_one_short_value(spark):
    nan = float("nan")
    data = [("ab", "c", None, 0.0, [1]), ("a", "bc", None, 0.0, [1]), (None, "a", 1, nan, None), ("a", None, 1, nan, None), ("a", None, 1, nan, None),
            ("1", "", 1, -0.0, [2]), ("1", "", 1, 0.0, [2]), ("1", None, 1, 0.0, [2])]
    df = spark.createDataFrame(data, "`a.b` string, c string, n int, d double, l array<int>")
    assert rows(profile.duplicate_profile(df)) == [(8, 6, 2)]
    plan = profile.duplicate_profile(df.drop("l"))._jdf.queryExecution().executedPlan().toString()
    assert "keys=[_digest#" in plan


def test_wide_rows_are_grouped_by_methods_that_the_jvm_compiles(spark):
    wide = spark.range(5).select(*[F.col("id").cast(f.dataType).alias(f.name) for f in schemas.LISTING.fields])
    found = wide.select(*row_digest(wide))._jdf.queryExecution().debug().codegenToSeq()
    assert max(found.apply(i)._3().maxMethodCodeSize() for i in range(found.length())) < 8000
