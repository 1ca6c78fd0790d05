"""Categorical encoders as fit/transform pairs.

A fit is one scan of the table whatever the number of columns: all (column, value) pairs go through
one aggregate, or one distinct and one range sort. Fitted statistics are tables of one row
per category, written once and joined back to the rows; under AQE a join whose fitted side measures below
the broadcast threshold becomes a broadcast join, otherwise it stays a shuffle join. Only
schema-defining facts reach the driver: one-hot category lists (bounded by ``max_categories``,
checked), the bit width of a binary code and global means. Models check the columns and types
they were fitted on; :mod:`stored` keeps them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import CONSIGNEE_PRIOR_WEIGHT, RARE_THRESHOLD, TARGET_ENCODE_ALPHA
from ..session import materialize
from .columns import bools_to_ints
from .ordering import global_index

# ------------------------------------------------------------------ one-hot


@dataclass
class OneHotModel:
    """Sorted categories per column; the first category of each is the dropped baseline. With ``types``
    (set by a fit) a table whose columns have other types is refused."""

    categories: dict[str, list[str]] = field(default_factory=dict)
    types: dict[str, str] = field(default_factory=dict)

    def dummy_names(self) -> list[str]:
        return [f"{c}_{v}" for c, vals in self.categories.items() for v in vals[1:]]

    def transform(self, df: DataFrame, ints: bool = True) -> DataFrame:
        """Replace each column by its dummies (appended last); NULL gives all zeros.

        ``ints`` then turns every boolean column of the frame into 0/1.
        """
        check_types(df, self.types)
        dummies = {}
        for c, vals in self.categories.items():
            s = F.col(c).cast("string")
            for v in vals[1:]:
                dummies[f"{c}_{v}"] = F.coalesce(s == F.lit(v), F.lit(False))
        out = df.select(*[F.col(x) for x in df.columns if x not in self.categories],
                        *[col.alias(n) for n, col in dummies.items()])
        return bools_to_ints(out) if ints else out


def _categories(df: DataFrame, columns: Sequence[str], max_categories: int, by: Sequence[str] = ()) -> DataFrame:
    """Distinct ``(by, column, value)`` without NULL values, from one scan of the table. Per column at most
    ``max_categories + 1`` distinct values go on (cut before the shuffle), which shows that there are too many."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"one-hot columns not present: {missing}")
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    pairs = (df.select(*by, F.explode(items).alias("p")).select(*by, "p.column", "p.value").where(F.col("value").isNotNull()).distinct())
    w = Window.partitionBy("column").orderBy("value")
    return pairs.withColumn("_n", F.dense_rank().over(w)).where(F.col("_n") <= max_categories + 1).drop("_n")


def _sorted_categories(df: DataFrame, columns: Sequence[str], pairs: DataFrame, max_categories: int) -> dict[str, list[str]]:
    """The categories of each column in the order of its type; raises when a column has too many."""
    found: dict[str, list[str]] = {c: [] for c in columns}
    for r in pairs.select("column", "value").distinct().collect():
        found[r["column"]].append(r["value"])
    for c, vals in found.items():
        if len(vals) > max_categories:
            raise ValueError(f"column {c!r} has more than {max_categories} categories")
        vals.sort(key=float if isinstance(df.schema[c].dataType, T.NumericType) else None)
    return found


def fit_one_hot(df: DataFrame, columns: Sequence[str], max_categories: int = 1024) -> OneHotModel:
    """Distinct non-null values per column (one job); raises when a column has more than ``max_categories``."""
    columns = list(columns)
    if not columns:
        return OneHotModel({})
    pairs = _categories(df, columns, max_categories)
    return OneHotModel(_sorted_categories(df, columns, pairs, max_categories), _types(df, columns))


def one_hot_per_group(df: DataFrame, columns: Sequence[str], by: str, max_categories: int = 1024) -> DataFrame:
    """One-hot encoding fitted for each value of ``by`` (an upload) on its own, in one plan.

    The columns are those of all groups together. In a group, a dummy that its own fit does not
    have (a value it does not contain, or its own baseline) is NULL, as when the
    groups' results are put under each other. ``max_categories`` bounds each column over all groups.
    """
    columns = list(columns)
    pairs = _categories(df, columns, max_categories, [by])
    every = _sorted_categories(df, columns, pairs, max_categories)
    order = {c: {v: n for n, v in enumerate(vals)} for c, vals in every.items()}
    own = pairs.groupBy(by).agg(*[
        F.collect_set(F.when(F.col("column") == c, F.col("value"))).alias(f"_own_{n}")  # at most max_categories values
        for n, c in enumerate(columns)])
    own = own.withColumnRenamed(by, "_by")
    out = df.join(own, F.col(by).eqNullSafe(F.col("_by")), "left")
    dummies = {}
    for n, c in enumerate(columns):
        s, mine = F.col(c).cast("string"), F.col(f"_own_{n}")
        for v in every[c]:
            smaller = [u for u in every[c] if order[c][u] < order[c][v]]
            is_dummy = F.array_contains(mine, v) & F.arrays_overlap(mine, F.array(*map(F.lit, smaller)).cast("array<string>"))
            dummies[f"{c}_{v}"] = F.when(is_dummy, F.coalesce(s == F.lit(v), F.lit(False)))
    # the smallest value of all groups is everyone's baseline where it occurs, and no dummy elsewhere
    dummies = {f"{c}_{v}": dummies[f"{c}_{v}"] for c in columns for v in every[c][1:]}
    out = out.select(*[F.col(x) for x in df.columns if x not in columns], *[d.alias(k) for k, d in dummies.items()])
    return bools_to_ints(out)


def apply_one_hot_encoding(df: DataFrame, columns: Sequence[str],
                           categories: dict[str, list[str]] | None = None,
                           max_categories: int = 1024) -> DataFrame:
    """``get_dummies(drop_first=True)`` + booleans to 0/1; pass ``categories`` to pin the schema."""
    model = OneHotModel(dict(categories)) if categories is not None else fit_one_hot(df, columns, max_categories)
    return model.transform(df)


# ------------------------------------------------------------------ fitted tables


def _types(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"columns not present: {missing}")
    return {c: df.schema[c].dataType.simpleString() for c in columns}


def check_types(df: DataFrame, fitted: dict[str, str]) -> None:
    """Raise unless ``df`` has the columns that a model was fitted on, with their types."""
    found = _types(df, list(fitted))
    wrong = [f"{c}: fitted on {t}, got {found[c]}" for c, t in fitted.items() if found[c] != t]
    if wrong:
        raise ValueError("columns differ from those of the fit: " + "; ".join(wrong))


def _exploded(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per row and listed column: its place in the list, its value as text and as number (numeric columns)."""
    def item(n: int, c: str):
        number = F.col(c).cast("double") if isinstance(df.schema[c].dataType, T.NumericType) else F.lit(None).cast("double")
        return F.struct(F.lit(n).alias("at"), number.alias("number"), F.col(c).cast("string").alias("category"))

    return df.select(F.explode(F.array(*[item(n, c) for n, c in enumerate(columns)])).alias("p")).select("p.at", "p.number", "p.category")


def _looked_up(df: DataFrame, column: str, table: DataFrame, at: int, value: str, name: str) -> DataFrame:
    """Add ``name``: ``value`` of the column's row in a fitted table, NULL if there is none. AQE broadcasts the
    fitted side when it measures below the broadcast threshold."""
    side = table.where(F.col("at") == at).select(F.col("category").alias("_category"), F.col(value).alias(name))
    return df.join(side, F.col(column).cast("string") == F.col("_category"), "left").drop("_category")


# ------------------------------------------------------------------ target encoding


@dataclass
class TargetModel:
    """Smoothed target mean of every category of some columns: ``at`` (place of the column), ``category, enc``."""

    types: dict[str, str]
    table: DataFrame
    global_mean: float | None

    def transform(self, df: DataFrame, unseen_global: bool = False) -> DataFrame:
        """Replace each column by its statistic. NULL stays NULL; an unseen category is NULL, or the global mean."""
        check_types(df, self.types)
        out = df
        for n, c in enumerate(self.types):
            out = _looked_up(out, c, self.table, n, "enc", "_enc")
            unseen = F.when(F.col(c).isNotNull(), F.lit(self.global_mean)) if unseen_global else F.lit(None)
            out = out.withColumn(c, F.coalesce("_enc", unseen.cast("double"))).drop("_enc")
        return out.select(*df.columns)


def fit_target(df: DataFrame, feature_list: Sequence[str], target_col: str, alpha: float = TARGET_ENCODE_ALPHA) -> TargetModel:
    """``(n * mean + alpha * global) / (n + alpha)`` per category, ``n`` its non-null targets.

    One scan and one aggregate for all features; the global mean is a row of the same aggregate.
    """
    features = list(feature_list)
    types = _types(df, features)
    t = F.col(target_col).cast("double").alias("_t")
    items = [F.struct(F.lit(-1).alias("at"), F.lit("").alias("category"))]  # all rows
    items += [F.struct(F.lit(n).alias("at"), F.col(c).cast("string").alias("category")) for n, c in enumerate(features)]
    rows = df.select(t, F.explode(F.array(*items)).alias("p")).select("_t", "p.at", "p.category").where(F.col("category").isNotNull())
    stats = materialize(rows.groupBy("at", "category").agg(F.sum("_t").alias("_s"), F.count("_t").alias("_n")), "target")
    g = stats.where("at = -1").select(F.col("_s") / F.nullif(F.col("_n"), F.lit(0))).first()
    g = None if g is None else g[0]
    enc = (F.col("_s") + F.lit(alpha) * F.lit(g).cast("double")) / (F.col("_n") + F.lit(alpha))
    return TargetModel(types, stats.where("at >= 0").select("at", "category", enc.alias("enc")), g)


def target_encode(df: DataFrame, feature_list: Sequence[str], target_col: str,
                  alpha: float = TARGET_ENCODE_ALPHA) -> DataFrame:
    """Replace each feature by the smoothed target mean of its category (:func:`fit_target` on the table itself)."""
    return fit_target(df, feature_list, target_col, alpha).transform(df)


# ------------------------------------------------------------------ ordinal and binary codes


@dataclass
class OrdinalModel:
    """Sorted dictionaries of some columns: ``at`` (place of the column), ``column, code`` (from 0), ``category``."""

    types: dict[str, str]
    table: DataFrame

    def mapping(self) -> DataFrame:
        return self.table.select("column", "code", "category")

    def codes(self, df: DataFrame) -> DataFrame:
        """Each column replaced by its code; NULL and unseen categories are -1."""
        check_types(df, self.types)
        out = df
        for n, c in enumerate(self.types):
            out = _looked_up(out, c, self.table, n, "code", "_code").withColumn(c, F.coalesce("_code", F.lit(-1))).drop("_code")
        return out.select(*df.columns)

    def bits(self, df: DataFrame) -> DataFrame:
        """Each column replaced by MSB-first bit columns ``c_bin0..`` of its code ('0'/'1'), appended
        last; NULL and unseen categories give NULL bits. Width = bit length of the largest code, at least 1."""
        check_types(df, self.types)
        largest = {r["column"]: r["m"] for r in self.table.groupBy("column").agg(F.max("code").alias("m")).collect()}  # a row per column
        out, added = df, []
        for n, c in enumerate(self.types):
            width = max(1, int(largest.get(c, 0)).bit_length())
            out = _looked_up(out, c, self.table, n, "code", "_code")
            code = F.col("_code")
            bits = {f"{c}_bin{i}": F.when(code.isNotNull(), F.shiftright(code, width - 1 - i).bitwiseAND(1).cast("string"))
                    for i in range(width)}
            out = out.withColumns(bits).drop("_code")
            added += bits
        return out.select(*[c for c in df.columns if c not in self.types], *added)


def fit_ordinal(df: DataFrame, columns: Sequence[str], partitions: int | None = None) -> OrdinalModel:
    """Dictionaries of all columns from one distinct and one range sort of (column, value).

    Numbers sort as numbers, all else as text. A code is a value's global place less that of its column's first.
    """
    columns = list(columns)
    types = _types(df, columns)
    spark = df.sparkSession
    schema = "at int, column string, code int, category string"
    if not columns:
        return OrdinalModel(types, spark.createDataFrame([], schema))
    values = _exploded(df, columns).where(F.col("category").isNotNull()).distinct()
    placed = global_index(values, ["at", "number", "category"], name="_place", partitions=partitions)
    first = placed.groupBy("at").agg(F.min("_place").alias("_first"))
    names = F.element_at(F.array(*map(F.lit, columns)), F.col("at") + 1)
    table = placed.join(F.broadcast(first), "at").select(  # first: one row per column
        "at", names.alias("column"), (F.col("_place") - F.col("_first")).cast("int").alias("code"), "category")
    return OrdinalModel(types, materialize(table, "dictionary"))


def convert_objects_to_ints(df: DataFrame, columns: Sequence[str] | None = None):
    """Each string column -> 0-based code of its sorted distinct values; NULL -> -1.

    Returns ``(encoded, mappings)`` where ``mappings`` has columns
    ``(column, code, category)``. Dictionaries are built with a distributed global
    rank, never a single-task window.
    """
    cols = list(columns) if columns is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    model = fit_ordinal(df, cols)
    return model.codes(df), model.mapping()


def binary_encode(df: DataFrame, categorical_features: Sequence[str]) -> DataFrame:
    """Replace each feature by MSB-first bit columns ``f_bin0..`` ('0'/'1') of its sorted code.

    Width = bit length of the largest code, at least 1; a NULL category gives NULL bits.
    """
    return fit_ordinal(df, categorical_features).bits(df)


# ------------------------------------------------------------------ consignee encoders


@dataclass
class ConsigneeModel:
    """Per consignee: occurrences in train and test together, and the smoothed target mean of its
    training rows (NULL without any): ``at`` (always 0), ``category, consignee_freq, enc``."""

    types: dict[str, str]
    table: DataFrame
    global_mean: float | None
    rare_thresh: int = RARE_THRESHOLD

    def transform(self, df: DataFrame, unseen_global: bool = True) -> DataFrame:
        """Add ``consignee_freq``, ``is_rare_consignee`` and ``consignee_target_enc``; a name that
        training has not seen gets the global mean (``unseen_global``) or NULL."""
        check_types(df, self.types)
        name = next(iter(self.types))
        side = self.table.select(F.col("category").alias("_category"), "consignee_freq", F.col("enc").alias("consignee_target_enc"))
        out = df.drop("consignee_freq", "consignee_target_enc", "is_rare_consignee")
        out = out.join(side, F.col(name).cast("string") == F.col("_category"), "left").drop("_category")
        if unseen_global:
            out = out.withColumn("consignee_target_enc", F.coalesce("consignee_target_enc", F.lit(self.global_mean).cast("double")))
        return out.withColumn("is_rare_consignee", F.coalesce(F.col("consignee_freq") < self.rare_thresh, F.lit(False)))


def fit_consignee(train: DataFrame, test: DataFrame | None = None, target_col: str = "one_day_pickup",
                  name_col: str = "consignee_name", rare_thresh: int = RARE_THRESHOLD,
                  global_weight: float = CONSIGNEE_PRIOR_WEIGHT) -> ConsigneeModel:
    """Frequencies over both tables, ``(mean * n + global * w) / (n + w)`` per name on the training rows, in one
    aggregate; the global mean is a row of it."""
    t = F.col(target_col).cast("double").alias("_t")
    name = F.col(name_col).cast("string").alias("category")
    both = train.select(name, t)
    if test is not None:
        both = both.unionByName(test.select(name, F.lit(None).cast("double").alias("_t")))
    items = F.array(F.struct(F.lit(-1).alias("at"), F.lit("").alias("category")), F.struct(F.lit(0).alias("at"), F.col("category")))
    rows = both.select("_t", F.explode(items).alias("p")).select("_t", "p.at", "p.category").where(F.col("category").isNotNull())
    stats = materialize(rows.groupBy("at", "category").agg(
        F.count(F.lit(1)).alias("consignee_freq"), F.sum("_t").alias("_s"), F.count("_t").alias("_n")), "consignees")
    g = stats.where("at = -1").select(F.col("_s") / F.nullif(F.col("_n"), F.lit(0))).first()
    g = None if g is None else g[0]
    enc = F.when(F.col("_n") > 0, (F.col("_s") + F.lit(g).cast("double") * F.lit(global_weight)) / (F.col("_n") + F.lit(global_weight)))
    table = stats.where("at = 0").select("at", "category", "consignee_freq", enc.alias("enc"))
    return ConsigneeModel(_types(train, [name_col]), table, g, rare_thresh)


def encode_consignee_features(train: DataFrame, test: DataFrame, target_col: str = "one_day_pickup",
                              name_col: str = "consignee_name", rare_thresh: int = RARE_THRESHOLD,
                              global_weight: float = CONSIGNEE_PRIOR_WEIGHT):
    """Frequency + rare flag from train and test together, target encoding fitted on train.

    Returns ``(train, test)``; train names always match, test names unseen in
    train get the training global mean.
    """
    model = fit_consignee(train, test, target_col, name_col, rare_thresh, global_weight)
    return model.transform(train, unseen_global=False), model.transform(test)
