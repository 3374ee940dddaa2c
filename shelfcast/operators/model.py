"""Tweedie demand models on the mart: preparation, fitting, prediction, backtest, importance.

The mart becomes one stored table of keys, label and an array of inputs, the same for every fold, configuration and store: all
inputs of a row are known a horizon before it. Models differ in the days they are fitted on, the inputs they may use
and the rows they belong to, and are all fitted together (`tweedie.fit`). The driver holds names, coefficients and dates.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from shelfcast.operators import holidays as holiday_ops
from shelfcast.operators import tweedie
from shelfcast.operators import weather as weather_ops
from shelfcast.operators.folds import assign_folds, checked, fold_table, integrity
from shelfcast.operators.forecast import post_process
from shelfcast.operators.lags import HORIZON
from shelfcast.operators.mart import CATEGORICAL, feature_columns
from shelfcast.operators.scoring import score
from shelfcast.operators.target_stats import with_target_means

EXTERNAL = {"weather": set(weather_ops.FEATURES), "holidays": set(holiday_ops.FEATURES)}
Models = Mapping[tuple[str, str], tweedie.Model]
Stage = Callable[[DataFrame, str], DataFrame]


class EmptyValidationError(RuntimeError):
    """The validation window holds no facts: a model fitted against it could not be judged."""


@dataclass(frozen=True)
class Inputs:
    """What each position of a row's inputs is: damped numbers, flags of missing ones, means of categories."""

    numeric: tuple[str, ...]
    flags: tuple[str, ...]
    categories: tuple[str, ...]

    @property
    def names(self) -> list[str]:
        return [*self.numeric, *(f"{c}_missing" for c in self.flags), *(f"{c}_mean" for c in self.categories)]

    def positions(self, without: Sequence[str] = ()) -> tuple[int, ...]:
        """Positions of the inputs that do not come from the named external sources."""
        dropped = set().union(*(EXTERNAL[name] for name in without)) if without else set()
        return tuple(k for k, c in enumerate([*self.numeric, *self.flags, *self.categories]) if c not in dropped)


@dataclass(frozen=True)
class Prepared:
    """Stored rows of id, store_id, date, day, sales, sell_price and x, and what x holds."""

    rows: DataFrame
    inputs: Inputs


def split_columns(mart: DataFrame) -> tuple[list[str], list[str]]:
    """Numeric and categorical features."""
    names = feature_columns(mart)
    return [c for c in names if c not in CATEGORICAL], [c for c in names if c in CATEGORICAL]


def category_index(train: DataFrame, categorical: Sequence[str]) -> PipelineModel:
    """Labels in alphabetical order, frozen on the training rows; unseen and missing values share one extra label."""
    indexer = StringIndexer(
        inputCols=list(categorical), outputCols=[f"{c}_index" for c in categorical],
        handleInvalid="keep", stringOrderType="alphabetAsc",
    )
    return Pipeline(stages=[indexer]).fit(train)


def inputs_of(mart: DataFrame) -> Inputs:
    """Columns that vary, a flag for each pattern of missing values, and all categories with two labels or more."""
    numeric, categorical = split_columns(mart)
    known = mart.filter(F.col("sales").isNotNull())
    # one small aggregation over (position, value) rows, where an aggregate per column would not compile
    value = F.col("value")
    stats = {
        row.pos: row
        for row in known.select(
            F.xxhash64("id", "date").alias("row"),
            F.posexplode(F.array(*[F.col(c).cast("double") for c in numeric])).alias("pos", "value"),
        ).groupBy("pos").agg(
            F.min(value).alias("lo"), F.max(value).alias("hi"), F.count_if(value.isNull()).alias("nulls"),
            # which rows are missing, whatever their order
            F.bit_xor(F.when(value.isNull(), F.col("row"))).alias("pattern"),
        ).collect()
    }
    used, flags, seen = [], [], set()
    for pos, c in enumerate(numeric):
        if pos not in stats or stats[pos].lo is None or stats[pos].lo == stats[pos].hi:
            continue
        used.append(c)
        # columns that are missing on the same rows need one flag only
        if stats[pos].nulls and (stats[pos].nulls, stats[pos].pattern) not in seen:
            seen.add((stats[pos].nulls, stats[pos].pattern))
            flags.append(c)
    labels = {}
    if categorical:
        some = known.agg(*[
            (F.approx_count_distinct(c) + F.max(F.col(c).isNull().cast("int"))).alias(c) for c in categorical
        ]).first()
        labels = {c: some[c] or 0 for c in categorical}
    return Inputs(tuple(used), tuple(flags), tuple(c for c in categorical if labels[c] > 1))


def prepare(mart: DataFrame, stage: Stage, horizon: int = HORIZON) -> Prepared:
    """The mart as model rows. Counts are damped by a logarithm, missing numbers become 0 with a flag; every category
    becomes one number (`with_target_means`), over rows with a price, whatever its number of labels."""
    inputs = inputs_of(mart)
    rows = with_target_means(mart, inputs.categories, F.col("sell_price").isNotNull(), stage, horizon)

    def damped(name: str):
        value = F.coalesce(F.col(name).cast("double"), F.lit(0.0))
        return F.signum(value) * F.log1p(F.abs(value))

    x = F.array(
        *[damped(c) for c in inputs.numeric], *[F.col(c).isNull().cast("double") for c in inputs.flags],
        *[F.col(f"{c}_mean") for c in inputs.categories],
    )
    kept = rows.select(
        "id", "store_id", "date", F.unix_date("date").alias("day"), F.col("sales").cast("double").alias("sales"), "sell_price",
        x.alias("x"),
    )
    return Prepared(stage(kept, "model_rows"), inputs)


def _with_facts(prepared: Prepared, start: date, end: date, by: str | None) -> None:
    """Raises if the window, or the window of a store that has models of its own, holds no fact."""
    inside = F.col("date").between(F.lit(start), F.lit(end)) & F.col("sales").isNotNull()
    if by is None:
        if prepared.rows.filter(inside).limit(1).count():
            return
        raise EmptyValidationError(f"no facts from {start} to {end}")
    empty = prepared.rows.groupBy(by).agg(F.count_if(inside).alias("n")).filter("n = 0").orderBy(by).limit(10).collect()
    if empty:
        raise EmptyValidationError(f"no facts from {start} to {end} of {', '.join(str(r[by]) for r in empty)}")


def _grouped(rows: DataFrame, by: str | None) -> DataFrame:
    return rows.withColumn("group", F.col(by).cast("string") if by else F.lit(""))


def fit(
    prepared: Prepared, variants: Sequence[tweedie.Variant], stage: Stage | None = None, by: str | None = None, **options
) -> Models:
    """All variants, over all rows or, with `by`, for each of its values, by (group, variant name).

    Rows without a price are left out: they are zero by rule (`post_process`), and a perfectly separated group has no
    finite coefficient under a log link. With `by` the rows are stored again, each group's next to each other, so that a
    task meets few groups; Spark splits large groups and joins small ones by their size.
    """
    known = F.col("sales").isNotNull() & F.col("sell_price").isNotNull()
    rows = _grouped(prepared.rows.filter(known), by).select("group", "day", F.col("sales").alias("y"), "x")
    if by:
        rows = stage(rows.hint("rebalance", F.col("group")), "training_rows")
    return tweedie.fit(rows, variants, len(prepared.inputs.names), **options)


def fit_window(
    prepared: Prepared, start: date, end: date, validation: tuple[date, date], stage: Stage | None = None,
    without: Sequence[str] = (), by: str | None = None, **options,
) -> Models:
    """One variant, named `model`, fitted from `start` to `end`. An empty validation window is an error."""
    _with_facts(prepared, *validation, by)
    variant = tweedie.Variant("model", start, end, prepared.inputs.positions(without))
    return fit(prepared, [variant], stage, by, **options)


def predict(
    prepared: Prepared, models: Models, windows: Mapping[str, tuple[date, date]], by: str | None = None
) -> DataFrame:
    """Post-processed predictions of each variant on its window: id, store_id, date, sales, variant, prediction."""
    first, last = min(a for a, _ in windows.values()), max(b for _, b in windows.values())
    rows = prepared.rows.filter(F.col("date").between(F.lit(first), F.lit(last)))
    scored = tweedie.predict(_grouped(rows, by), models, dict(windows))
    return post_process(scored).select("id", "store_id", "date", "sales", "variant", "prediction")


def fit_folds(
    prepared: Prepared, folds: Sequence[Row], configs: Mapping[str, Sequence[str]], horizon: int = HORIZON, **options
) -> tuple[Models, dict[str, tuple[date, date]]]:
    """Models of every configuration on every fold, named `config@fold`, and the validation days of each."""
    cut = checked(fold_table(prepared.rows.sparkSession, folds), integrity(horizon))
    for f in cut:
        _with_facts(prepared, f.val_start, f.val_end, None)
    named = {f"{config}@{f.fold}": (config, f) for config in configs for f in cut}
    variants = [
        tweedie.Variant(name, f.train_start, f.train_end, prepared.inputs.positions(configs[config]))
        for name, (config, f) in named.items()
    ]
    return fit(prepared, variants, **options), {name: (f.val_start, f.val_end) for name, (_, f) in named.items()}


def backtest(
    prepared: Prepared, folds: Sequence[Row], configs: Mapping[str, Sequence[str]], horizon: int = HORIZON, **options
) -> DataFrame:
    """Refit on every fold with every configuration: config, fold, id, date, sales and prediction of validation facts.

    `configs` name the external sources each configuration goes without. All models of all folds are fitted by the same
    scans of the same rows, and predict in one.
    """
    models, windows = fit_folds(prepared, folds, configs, horizon, **options)
    scored = predict(prepared, models, windows)
    parts = F.split("variant", "@")
    return scored.filter(F.col("sales").isNotNull()).select(
        parts[0].alias("config"), parts[1].cast("int").alias("fold"), "id", "date", "sales", "prediction"
    )


def backtest_scores(predictions: DataFrame, facts: DataFrame, folds: Sequence[Row], configs: Sequence[str]) -> DataFrame:
    """Metrics per configuration and fold over all facts of the validation window."""
    actual = assign_folds(facts, list(folds), ("validation",)).select(
        "fold", "id", "date", "sales", F.explode(F.array(*[F.lit(c) for c in configs])).alias("config")
    )
    return score(actual, predictions.drop("sales"), ("config", "fold", "id", "date"), ("config", "fold"))


def fit_trees(prepared: Prepared, start: date, end: date, validation: tuple[date, date], max_iter: int = 200) -> GBTRegressionModel:
    """Boosted trees on the same inputs over all stores, which stop early on the validation window."""
    _with_facts(prepared, *validation, None)
    known = prepared.rows.filter(F.col("sales").isNotNull())
    day = F.col("date")
    held_out = day.between(F.lit(validation[0]), F.lit(validation[1]))
    rows = known.filter(day.between(F.lit(start), F.lit(end)) | held_out).select(
        F.col("sales").alias("label"), array_to_vector("x").alias("features"), held_out.alias("is_validation")
    )
    trees = GBTRegressor(maxIter=max_iter, maxDepth=5, maxBins=256, seed=42, validationIndicatorCol="is_validation")
    return trees.fit(rows)


def predict_trees(model: GBTRegressionModel, rows: DataFrame) -> DataFrame:
    """Post-processed predictions of prepared rows: id, store_id, date, sales, prediction."""
    scored = model.transform(rows.withColumn("features", array_to_vector("x")))
    return post_process(scored).select("id", "store_id", "date", "sales", "prediction")


def _source(inputs: Inputs) -> list[str]:
    """The mart column of each input."""
    return [*inputs.numeric, *inputs.flags, *inputs.categories]


def feature_importance(models: Models, prepared: Prepared) -> DataFrame:
    """Mean weight of each feature over the models, its share of all, and in how many models it is used; largest first.

    A weight is the size of the coefficients on standardised inputs. One row per feature and model is read from the models.
    """
    sources = _source(prepared.inputs)
    rows = [
        (" ".join(key), sources[k], abs(float(b)))
        for key, m in models.items() for k, b in zip(m.used.tolist(), m.beta[1:], strict=True)
    ]
    gain = F.sum("weight") / F.lit(float(len(models)))
    spark = prepared.rows.sparkSession
    summed = spark.createDataFrame(rows, "model string, feature string, weight double").groupBy("feature").agg(
        gain.alias("gain"), F.count_distinct("model").alias("n_models")
    )
    total = summed.agg(F.sum("gain")).scalar()
    return summed.withColumn("gain_share", F.col("gain") / F.nullif(total, F.lit(0.0))).orderBy(F.desc("gain"), "feature")


def permutation_importance(
    models: Models, prepared: Prepared, windows: Mapping[str, tuple[date, date]], by: str | None = None, seed: int = 42
) -> DataFrame:
    """How much WMAPE grows when a feature's values change places between rows, by model: mean, deviation and number of models.

    `windows` are the validation days of each variant. Inputs of one feature (its number and its flag) are added up.
    """
    known = F.col("sales").isNotNull() & F.col("sell_price").isNotNull()
    rows = _grouped(prepared.rows.filter(known), by).select("group", "day", F.col("sales").alias("y"), "x")
    errors = tweedie.permuted_errors(rows, dict(models), dict(windows), seed)
    plain = errors.filter("position = -1").select("group", "variant", F.col("abs_error").alias("plain"))
    names = F.array(*[F.lit(c) for c in _source(prepared.inputs)])
    growth = F.sum((F.col("abs_error") - F.col("plain")) / F.nullif("volume", F.lit(0.0)))
    by_model = errors.filter("position >= 0").join(plain, ["group", "variant"]).groupBy(
        "group", "variant", F.element_at(names, F.col("position") + 1).alias("feature")
    ).agg(growth.alias("growth"))
    return by_model.groupBy("feature").agg(
        F.avg("growth").alias("wmape_growth"), F.stddev_pop("growth").alias("wmape_growth_std"), F.count("growth").alias("n_models")
    )


def write_importance(importance: DataFrame, path: str) -> None:
    """The table as CSV with a header, the most important feature first."""
    importance.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
