"""Feature preparation: fills, categories, dummies, splits, weights, input contract."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.scores import hash_percent
from touchline.operators.aggregates import class_ratio, top_values
from touchline.operators.ordering import hash_slice, ordinals, value_summary, with_slice
from touchline.session import on_release

# The feature groups of the propensity model.
REFERRAL = ["refr_urlhost", "refr_medium"]
MARKETING = ["mkt_medium", "mkt_source", "mkt_term"]
GEOGRAPHY = ["geo_country", "geo_region", "br_lang"]
DEVICE = ["device_family", "os_family"]
LANDING = ["first_page_title"]
ENGAGEMENT = ["engaged_time_in_s", "absolute_time_in_s", "vertical_percentage_scrolled"]
CATEGORICAL = REFERRAL + MARKETING + GEOGRAPHY + DEVICE + LANDING
CONTINUOUS = ENGAGEMENT

MISSING = "N/A"
OTHER = "Other"


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def other_columns(df: DataFrame, excluded: Sequence[str]) -> list[str]:
    """Columns that are neither text nor excluded; pass the label as excluded."""
    return [f.name for f in df.schema if not isinstance(f.dataType, T.StringType) and f.name not in excluded]


class _Columns(Params):
    columns = Param(Params._dummy(), "columns", "columns to work on", TypeConverters.toListString)

    def setColumns(self, value: Sequence[str]):  # noqa: N802
        return self._set(columns=list(value))


class FillCategories(Transformer, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Put a marker where a category is missing."""

    marker = Param(Params._dummy(), "marker", "text for missing", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, columns: Sequence[str] | None = None, marker: str = MISSING):
        super().__init__()
        self._setDefault(marker=MISSING)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.na.fill(self.getOrDefault("marker"), self.getOrDefault("columns"))


class CastToDouble(Transformer, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Numeric feature columns as doubles."""

    @keyword_only
    def __init__(self, *, columns: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.col(c).cast("double") for c in self.getOrDefault("columns")})


class TopKCategories(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Keep the k most frequent values of each column and call the rest "Other".

    Fitted on the training rows; equal counts go to the smaller value.
    """

    k = Param(Params._dummy(), "k", "values to keep per column", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, columns: Sequence[str] | None = None, k: int = 20):
        super().__init__()
        self._setDefault(k=20)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> TopKCategoriesModel:
        columns = self.getOrDefault("columns")
        kept: dict[str, list[str]] = {c: [] for c in columns}
        # k values per column come back, whatever the size of the data.
        for row in top_values(df, columns, self.getOrDefault("k")).orderBy("column", "rank").collect():
            kept[row["column"]].append(row["value"])
        return TopKCategoriesModel(columns=columns, kept=json.dumps(kept))


class TopKCategoriesModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    kept = Param(Params._dummy(), "kept", "kept values per column, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, columns: Sequence[str] | None = None, kept: str = "{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    def vocabulary(self) -> dict[str, list[str]]:
        return json.loads(self.getOrDefault("kept"))

    def _transform(self, df: DataFrame) -> DataFrame:
        def cut(name: str, values: list[str]) -> Column:
            text = F.col(name).cast("string")
            return F.when(text.isin(values), text).otherwise(OTHER) if values else F.lit(OTHER)

        return df.withColumns({c: cut(c, values) for c, values in self.vocabulary().items()})


class DummyColumns(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """One 0/1 column per value seen in training, named ``column_value`` in sorted order.

    A dot in a value, which Spark reads as a field's name, becomes an
    underscore; a name that is taken gets a number. Null and unseen values give
    zeros throughout. A column with more than
    ``limit`` values is refused: cut it down with ``TopKCategories`` first.
    """

    limit = Param(Params._dummy(), "limit", "most values per column", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, columns: Sequence[str] | None = None, limit: int = 500):
        super().__init__()
        self._setDefault(limit=500)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> DummyColumnsModel:
        columns, limit = self.getOrDefault("columns"), self.getOrDefault("limit")
        seen: dict[str, list[str]] = {c: [] for c in columns}
        for row in top_values(df, columns, limit + 1).collect():
            seen[row["column"]].append(row["value"])
        for name, values in seen.items():
            if len(values) > limit:
                raise ValueError(f"{name} has more than {limit} values; use TopKCategories first")
        return DummyColumnsModel(columns=columns, values=json.dumps({c: sorted(v) for c, v in seen.items()}))


class DummyColumnsModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    values = Param(Params._dummy(), "values", "values per column, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, columns: Sequence[str] | None = None, values: str = "{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _named(self) -> dict[str, tuple[str, str]]:
        """Column and value behind each name."""
        named: dict[str, tuple[str, str]] = {}
        for column, values in json.loads(self.getOrDefault("values")).items():
            for value in values:
                name = base = f"{column}_{value}".replace(".", "_")
                number = 1
                while name in named:
                    number += 1
                    name = f"{base}_{number}"
                named[name] = (column, value)
        return named

    def dummy_names(self) -> list[str]:
        return list(self._named())

    def _transform(self, df: DataFrame) -> DataFrame:
        made = {
            name: F.coalesce(F.col(c).cast("string") == v, F.lit(False)).cast("int") for name, (c, v) in self._named().items()
        }
        return df.withColumns(made).drop(*self.getOrDefault("columns"))


# ---- splits ----------------------------------------------------------------


def hash_split(df: DataFrame, key: str, train_percent: int, salt: str = "") -> tuple[DataFrame, DataFrame]:
    """Train and test by a hash of the key: the same rows in every run and on every cluster."""
    bucket = hash_percent(F.col(key), salt)
    return df.where(bucket < train_percent), df.where(bucket >= train_percent)


def random_split(df: DataFrame, fractions: Sequence[float], seed: int | None = None) -> list[DataFrame]:
    """Spark's random split; the rows that go where depend on the partitioning."""
    return df.randomSplit(list(fractions), seed)


def ordered_split(
    df: DataFrame, order: str, tie: str, tenths: int = 8, slices: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """The first ``tenths`` tenths of the rows by ``order``, and the rest.

    Like taking the first ``n // 10 * tenths`` rows, but with an order of its
    own. ``order`` is numeric; null and NaN come last. Equal values are ordered
    by the hash of ``tie``, then ``tie``, and cut by that hash, so a value that
    many rows share is no single task. Positions come from sliced counts.
    """
    value = F.col(order).cast("double")
    ranked = df.withColumn("_order", F.when(~F.isnan(value), value))
    n, bounds = value_summary(ranked, "_order", slices)
    sliced = with_slice(ranked, "_order", bounds, "_by_value")
    # A value with more rows than a slice is the lower bound of one: it comes first there, and is cut by hash.
    shared = F.col("_order").isNull() | F.col("_order").isin(bounds)
    by_value = F.coalesce("_by_value", F.lit(len(bounds) + 1))
    cut = F.struct(by_value.alias("slice"), (~shared).alias("single"), F.when(shared, hash_slice(F.col(tie), n)).otherwise("").alias("hash"))
    by = [F.col("_order").asc_nulls_last(), F.md5(F.col(tie).cast("string")), tie]
    placed = ordinals(sliced.withColumn("_slice", cut), [], "_slice", by, "_position")
    placed = placed.drop("_slice", "_by_value", "_order")
    last = n // 10 * tenths
    return placed.where(F.col("_position") <= last).drop("_position"), placed.where(F.col("_position") > last).drop("_position")


def with_class_weight(df: DataFrame, label: str, weight: float | None = None, name: str = "weight") -> DataFrame:
    """A weight column: ``weight`` for positives (default: negatives per positive), 1 for the rest."""
    if weight is None:
        weight = class_ratio(df, label).first()["ratio"] or 1.0
    return df.withColumn(name, F.when(F.col(label) == 1, float(weight)).otherwise(1.0))


def materialised(df: DataFrame) -> DataFrame:
    """Keep a prepared set for the many passes of model training, filling the cache at once."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    kept.count()
    on_release(kept.unpersist)
    return kept


# ---- input contract ----------------------------------------------------------


def input_contract(df: DataFrame, columns: Sequence[str]) -> str:
    """Names and types of the model's inputs, as text to be stored with the model."""
    return df.select(*columns).schema.json()


def enforce_contract(df: DataFrame, contract: str) -> DataFrame:
    """Check that all inputs are there with their types; extra columns may stay."""
    wanted = T.StructType.fromJson(json.loads(contract))
    have = {f.name: f.dataType for f in df.schema}
    wrong = [
        f"{f.name}: expected {f.dataType.simpleString()}, got {have[f.name].simpleString() if f.name in have else 'nothing'}"
        for f in wanted
        if f.name not in have or have[f.name] != f.dataType
    ]
    if wrong:
        raise ValueError("input does not match the model: " + "; ".join(wrong))
    return df
