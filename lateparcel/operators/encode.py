"""Feature encoding and scaling: fitted on one frame, applied to any other."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateparcel.functions import lenient_number, strict_timestamp
from lateparcel.operators.checks import (
    SMALL_TABLE_ROWS,
    columns_of_kind,
    require_columns,
    settle_small,
)
from lateparcel.operators.clean import only_delivered, with_late_target
from lateparcel.operators.profile import describe_texts
from lateparcel.operators.quantile import exact_quantiles
from lateparcel.operators.rank import WINDOW_DISTINCT, running_counts
from lateparcel.operators.sample import fraction_sample

# One-hot columns widen the plan, so the number of categories is limited.
MOST_CATEGORIES = 10_000

# The features of the delay models.
NUMERIC_FEATURES = ("delivery_time", "customer_zip_code_prefix", "order_month", "order_year")
CATEGORICAL_FEATURES = ("customer_state",)
# Columns that are never features of the loyalty model.
NOT_FEATURES = ("order_id", "customer_id", "loyal_customer", "order_status", "order_year_month")


def category_counts(frame: DataFrame, names: Sequence[str]) -> dict[str, dict[str, int]]:
    """Rows per known value of each column, from one shuffle of (column, value) pairs."""
    if not names:
        return {}
    counted = (
        frame.select(
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(n).alias("c"), F.col(f"`{n}`").cast("string").alias("v"))
                        for n in names
                    ]
                )
            )
        )
        .where(F.col("v").isNotNull())
        .groupBy("c", "v")
        .agg(F.count("*").alias("n"))
        .limit(MOST_CATEGORIES + 1)
        .collect()
    )
    if len(counted) > MOST_CATEGORIES:
        raise ValueError(f"too many categories to encode as columns: {list(names)}")
    found: dict[str, dict[str, int]] = {n: {} for n in names}
    for row in counted:
        found[row["c"]][row["v"]] = row["n"]
    return found


def fit_categories(frame: DataFrame, names: Sequence[str]) -> dict[str, list[str]]:
    """Sorted known values per column."""
    return {n: sorted(values) for n, values in category_counts(frame, names).items()}


def one_hot_columns(name: str, values: Sequence[str], kind: str = "int") -> dict[str, Column]:
    """0/1 columns ``<name>_<value>``; null and unseen values are zero everywhere."""
    text = F.col(f"`{name}`").cast("string")
    return {
        f"{name}_{value}": F.coalesce(text == F.lit(value), F.lit(False)).cast(kind)
        for value in values
    }


def encode_features(frame: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """One-hot of the state without its alphabetically first value; the city is dropped."""
    require_columns(frame, ["customer_state", "customer_city"], "categorical encoding")
    if categories is None:
        categories = fit_categories(frame, ["customer_state"])["customer_state"]
    encoded = one_hot_columns("customer_state", list(categories)[1:])
    return frame.withColumns(encoded).drop("customer_state", "customer_city")


def label_encode(
    frame: DataFrame,
    names: Sequence[str],
    suffix: str = "_enc",
    small_rows: int = SMALL_TABLE_ROWS,
) -> DataFrame:
    """Alphabetical code of each value, starting at 0.

    One pass finds the distinct (column, value) pairs of all columns.  The code tables are
    joined; their size decides how.
    """
    names = list(names)
    pairs = (
        frame.select(
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(i).alias("at"), F.col(f"`{n}`").alias("value"))
                        for i, n in enumerate(names)
                    ]
                )
            )
        )
        .where(F.col("value").isNotNull())
        .distinct()
    )
    values = settle_small(pairs, small_rows)
    many = WINDOW_DISTINCT + 1 if values is pairs else 0
    codes = running_counts(
        values.withColumn("n", F.lit(1)), ["at"], "value", "n", many
    ).withColumn("code", F.col("before").cast("int"))
    for i, name in enumerate(names):
        own = codes.where(F.col("at") == i).select(
            F.col("value").alias(name), F.col("code").alias(f"{name}{suffix}")
        )
        frame = frame.join(own, name, "left")
    return frame


@dataclass(frozen=True)
class Scaler:
    """Standardising with the mean and population deviation of the frame it was fitted on."""

    means: dict[str, float | None]
    stds: dict[str, float | None]

    @staticmethod
    def fit(frame: DataFrame, names: Sequence[str]) -> Scaler:
        names = list(names)
        row = frame.agg(
            *[F.avg(F.col(f"`{n}`")).alias(f"m{i}") for i, n in enumerate(names)],
            *[
                F.when(F.min(F.col(f"`{n}`")) == F.max(F.col(f"`{n}`")), F.lit(0.0))
                .otherwise(F.stddev_pop(F.col(f"`{n}`")))
                .alias(f"s{i}")
                for i, n in enumerate(names)
            ],
        ).head()
        return Scaler(
            {n: row[f"m{i}"] for i, n in enumerate(names)},
            {n: row[f"s{i}"] for i, n in enumerate(names)},
        )

    def scaled(self, name: str) -> Column:
        """A constant column is only centred."""
        std = self.stds[name]
        return (F.col(f"`{name}`") - F.lit(self.means[name]).cast("double")) / F.lit(
            std if std else 1.0
        )

    def transform(self, frame: DataFrame, suffix: str = "") -> DataFrame:
        return frame.withColumns({f"{n}{suffix}": self.scaled(n) for n in self.means})


@dataclass(frozen=True)
class Imputer:
    """Median for numbers, most frequent value for text, as fitted."""

    medians: dict[str, float | None]
    modes: dict[str, str | None]

    @staticmethod
    def fit(frame: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = ()) -> Imputer:
        medians = {n: v[0] for n, v in exact_quantiles(frame, numeric, [0.5]).items()}
        modes = {}
        if categorical:
            for row in describe_texts(frame, categorical).collect():
                modes[row["column"]] = row["top"]
        return Imputer(medians, modes)

    def filled(self, name: str) -> Column:
        if name in self.medians:
            return F.coalesce(F.col(f"`{name}`").cast("double"), F.lit(self.medians[name]))
        return F.coalesce(F.col(f"`{name}`"), F.lit(self.modes[name]))

    def transform(self, frame: DataFrame) -> DataFrame:
        return frame.withColumns({n: self.filled(n) for n in [*self.medians, *self.modes]})


@dataclass(frozen=True)
class TabularEncoder:
    """One-hot of every text column without its first value, then scaling of every column.

    Categories, means and deviations come from the training frame only, so a test frame always
    gets the same columns: categories missing there are 0, unseen ones are ignored.
    """

    numeric: tuple[str, ...]
    categories: dict[str, list[str]]
    scaler: Scaler
    scale: bool = True

    @staticmethod
    def fit(train: DataFrame, features: Sequence[str], scale: bool = True) -> TabularEncoder:
        chosen = train.select(*features)
        numeric = tuple(columns_of_kind(chosen, "number"))
        categories = fit_categories(chosen, columns_of_kind(chosen, "string"))
        plain = TabularEncoder(numeric, categories, Scaler({}, {}), False)
        if not scale:
            return plain
        return TabularEncoder(
            numeric, categories, Scaler.fit(plain.transform(train), plain.columns)
        )

    @property
    def dummies(self) -> dict[str, Column]:
        found: dict[str, Column] = {}
        for name, values in self.categories.items():
            found.update(one_hot_columns(name, values[1:]))
        return found

    @property
    def columns(self) -> list[str]:
        return [*self.numeric, *self.dummies]

    def transform(self, frame: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Encoded (and scaled) columns next to the columns to keep, such as key and label."""
        encoded = frame.select(
            *keep,
            *[F.col(f"`{n}`") for n in self.numeric],
            *[value.alias(name) for name, value in self.dummies.items()],
        )
        return self.scaler.transform(encoded) if self.scale else encoded


def feature_matrix(
    frame: DataFrame, not_features: Sequence[str] = NOT_FEATURES, keep: Sequence[str] = ()
) -> DataFrame:
    """Numeric and boolean columns only, booleans as int, nulls as 0; ids and label dropped.

    ``keep`` names columns to carry along unchanged, such as key, label and split.
    """
    rest = frame.drop(*not_features, *keep)
    columns = {n: F.coalesce(F.col(f"`{n}`"), F.lit(0)) for n in columns_of_kind(rest, "number")}
    columns.update(
        {
            n: F.coalesce(F.col(f"`{n}`").cast("int"), F.lit(0))
            for n in columns_of_kind(rest, "bool")
        }
    )
    return frame.select(*keep, *[columns[n].alias(n) for n in rest.columns if n in columns])


def delay_frame(
    orders: DataFrame,
    keys: Sequence[str] = ("order_id",),
    sample_frac: float = 1.0,
    fill_before_split: bool = False,
    seed: int = 42,
) -> DataFrame:
    """Modelling frame: delivered orders, typed dates, numeric zip, both targets.

    One lazy plan.  ``fill_before_split`` also fills what is still null with medians of the whole
    frame and 'unknown'; by default that is left to preprocessing, which sees train rows only.
    """
    frame = only_delivered(orders)
    if "order_purchase_timestamp" in frame.columns:
        bought = strict_timestamp("order_purchase_timestamp")
        frame = frame.withColumns({"order_year": F.year(bought), "order_month": F.month(bought)})
    require_columns(
        frame, ["delivery_delay", *NUMERIC_FEATURES, *CATEGORICAL_FEATURES], "modelling frame"
    )
    frame = frame.withColumn(
        "customer_zip_code_prefix", lenient_number("customer_zip_code_prefix")
    ).dropna(
        subset=["delivery_delay", "delivery_time", "customer_state", "customer_zip_code_prefix"]
    )
    frame = with_late_target(frame)
    frame = fraction_sample(frame, keys, sample_frac, seed).select(
        *keys, *NUMERIC_FEATURES, *CATEGORICAL_FEATURES, "delivery_delay", "target"
    )
    if not fill_before_split:
        return frame
    frame = Imputer.fit(frame, NUMERIC_FEATURES).transform(frame)
    return frame.fillna({name: "unknown" for name in CATEGORICAL_FEATURES})


@dataclass(frozen=True)
class Preprocessor:
    """Numeric branch (median, scaling) and categorical branch (mode, one-hot) into a vector.

    Unknown categories are zero everywhere.  ``feature_names`` follow the order of the vector.
    """

    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    imputer: Imputer
    scaler: Scaler
    categories: dict[str, list[str]] = field(default_factory=dict)

    @staticmethod
    def fit(
        train: DataFrame,
        numeric: Sequence[str] = NUMERIC_FEATURES,
        categorical: Sequence[str] = CATEGORICAL_FEATURES,
    ) -> Preprocessor:
        counts = category_counts(train, categorical)
        # most frequent first, the smaller value on a tie
        modes = {n: min(c, key=lambda v: (-c[v], v)) for n, c in counts.items() if c}
        imputer = Imputer(Imputer.fit(train, numeric).medians, modes)
        filled = imputer.transform(train)
        return Preprocessor(
            tuple(numeric),
            tuple(categorical),
            imputer,
            Scaler.fit(filled, numeric),
            {n: sorted(values) for n, values in counts.items()},
        )

    @property
    def feature_names(self) -> list[str]:
        return [
            *[f"num__{n}" for n in self.numeric],
            *[f"cat__{n}_{v}" for n in self.categorical for v in self.categories[n]],
        ]

    def transform(self, frame: DataFrame, keep: Sequence[str], vector: str = "features"):
        filled = self.imputer.transform(frame)
        columns = [self.scaler.scaled(n) for n in self.numeric]
        for n in self.categorical:
            columns += one_hot_columns(n, self.categories[n], "double").values()
        names = [f"__x{i}" for i in range(len(columns))]
        wide = filled.select(*keep, *[c.alias(n) for c, n in zip(columns, names)])
        return VectorAssembler(inputCols=names, outputCol=vector).transform(wide).drop(*names)


def assemble(frame: DataFrame, names: Sequence[str], vector: str = "features") -> DataFrame:
    """Numeric columns into one vector; names may hold any character."""
    safe = {f"__x{i}": F.col(f"`{n}`").cast("double") for i, n in enumerate(names)}
    wide = frame.withColumns(safe)
    return VectorAssembler(inputCols=list(safe), outputCol=vector).transform(wide).drop(*safe)
