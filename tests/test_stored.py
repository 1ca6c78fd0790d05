"""Encoders: one-pass fits, models kept as versioned tables."""

import pytest
from pyspark.sql import functions as F

from berthline.operators import encode as E
from berthline.operators import stored
from berthline.session import scratch_path


def _rows(df):
    return sorted(map(repr, df.collect()))


def _table(spark):
    rows = [(i, ["x", "y", None, "z w"][i % 4], i % 3 if i % 5 else None, f"c{i % 7}" if i % 6 else None,
             None if i % 4 == 3 else i % 2) for i in range(60)]
    return spark.createDataFrame(rows, "id int, a string, n int, who string, t int")


def test_models_survive_a_save_and_a_load(spark):
    df = _table(spark)
    new = spark.createDataFrame([(1, "z w", 2, "c1", 1), (2, "unseen", 9, "c99", 0), (3, None, None, None, None)], df.schema)
    root = scratch_path(spark, "models")
    models = {
        "one_hot": (E.fit_one_hot(df, ["a", "n"]), lambda m, d: m.transform(d)),
        "codes": (E.fit_ordinal(df, ["a", "n"]), lambda m, d: m.codes(d)),
        "bits": (E.fit_ordinal(df, ["a", "who"]), lambda m, d: m.bits(d)),
        "target": (E.fit_target(df, ["a", "n", "who"], "t"), lambda m, d: m.transform(d, unseen_global=True)),
        "consignee": (E.fit_consignee(df, new, "t", "who"), lambda m, d: m.transform(d)),
    }
    for name, (model, use) in models.items():
        assert stored.save(spark, model, f"{root}/{name}", note="first") == 1
    other = spark.newSession()
    for name, (model, use) in models.items():
        back = stored.load(other, f"{root}/{name}")
        assert type(back) is type(model) and back.types == model.types
        for d in (df, new):
            d = other.createDataFrame([tuple(r) for r in d.collect()], d.schema)
            assert _rows(use(back, d)) == _rows(use(model, spark.createDataFrame([tuple(r) for r in d.collect()], d.schema)))
        with pytest.raises(ValueError, match="fitted on"):
            use(back, other.createDataFrame([(1, 2.5, 1.5, 7, 1)], "id int, a double, n double, who int, t int"))
        with pytest.raises(KeyError):
            use(back, other.createDataFrame([(1,)], "id int"))


def test_versions_are_kept_and_incomplete_ones_ignored(spark):
    df, root = _table(spark), scratch_path(spark, "versions")
    with pytest.raises(FileNotFoundError):
        stored.load(spark, root)
    stored.save(spark, E.fit_one_hot(df, ["a"]), root)
    stored.save(spark, E.fit_one_hot(df.where("a <> 'y'"), ["a"]), root, note="no y")
    df.select("id").write.parquet(f"{root}/version=3/table")  # a save that did not end
    assert stored.load(spark, root).categories == {"a": ["x", "z w"]}
    assert stored.load(spark, root, 1).categories == {"a": ["x", "y", "z w"]}
    assert [r["note"] for r in stored.versions(spark, root).orderBy("version").collect()] == ["", "no y"]


def test_fits_read_the_table_once(spark):
    """Whatever the number of columns: one scan, one distinct or aggregate, one range sort."""
    path = scratch_path(spark, "scan")
    _table(spark).write.parquet(path)
    df = spark.read.parquet(path)
    plans = []
    explode = F.explode

    def count(plan):
        return plan.count("FileScan parquet")

    for columns in (["a"], ["a", "n", "who"]):
        pairs = E._categories(df, columns, 10)
        plans.append(count(pairs._jdf.queryExecution().executedPlan().toString()))
        plans.append(count(E._exploded(df, columns).distinct()._jdf.queryExecution().executedPlan().toString()))
    assert plans == [1, 1, 1, 1] and explode is F.explode


def test_numbers_sort_as_numbers_and_empty_tables_fit(spark):
    df = spark.createDataFrame([(10, "b"), (9, "a"), (100, None), (None, "a")], "n int, s string")
    model = E.fit_ordinal(df, ["n", "s"])
    assert [tuple(r) for r in model.mapping().orderBy("column", "code").collect()] == [
        ("n", 0, "9"), ("n", 1, "10"), ("n", 2, "100"), ("s", 0, "a"), ("s", 1, "b")]
    assert sorted(map(tuple, model.codes(df).collect())) == [(-1, 0), (0, 0), (1, 1), (2, -1)]
    empty = df.limit(0)
    assert E.fit_ordinal(empty, ["n", "s"]).codes(df).where("n = -1 and s = -1").count() == 4
    assert E.fit_target(empty.withColumn("t", F.lit(1)), ["s"], "t").global_mean is None
    assert E.fit_one_hot(empty, ["s"]).categories == {"s": []}


def test_a_category_without_targets_has_no_statistic(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 0.0), ("b", None), (None, 1.0)], "s string, t double")
    got = {r["s0"]: r["s"] for r in E.target_encode(df.withColumn("s0", F.col("s")), ["s"], "t", alpha=2).collect()}
    assert got["a"] == pytest.approx((1 + 2 * 2 / 3) / 4) and got["b"] is None and got[None] is None


def test_one_hot_of_groups_equals_each_alone(spark):
    df = spark.createDataFrame([("u", "b", 1), ("u", "c", 2), ("u", None, 1), ("v", "a", 2), ("v", "c", 10), ("w", None, None)],
                               "g string, s string, n int")
    got = E.one_hot_per_group(df, ["s", "n"], "g")
    assert got.columns == ["g", "s_b", "s_c", "n_2", "n_10"]
    for g in ("u", "v", "w"):
        alone = E.apply_one_hot_encoding(df.where(F.col("g") == g), ["s", "n"])
        mine = got.where(F.col("g") == g)
        assert _rows(mine.select(*alone.columns)) == _rows(alone)
        for c in set(got.columns) - set(alone.columns):
            assert mine.where(F.col(c).isNotNull()).count() == 0
    with pytest.raises(ValueError, match="more than 2"):
        E.one_hot_per_group(df, ["s", "n"], "g", max_categories=2)
