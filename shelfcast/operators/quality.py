"""Data-quality rules, panel invariants, leakage checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A condition every row must meet. NULL values are judged by `required` alone."""

    column: str
    name: str
    holds: Column | None = None


@dataclass(frozen=True)
class RuleSet:
    name: str
    types: dict[str, str]
    required: Sequence[str]
    rules: Sequence[Rule] = ()
    unique: Sequence[Sequence[str]] = field(default_factory=tuple)


def between(column: str, low, high) -> Rule:
    return Rule(column, f"in_range({low},{high})", F.col(column).between(low, high))


def one_of(column: str, values: Sequence) -> Rule:
    return Rule(column, "in_set", F.col(column).isin(*values))


def matches(column: str, pattern: str) -> Rule:
    return Rule(column, "matches", F.col(column).rlike(pattern))


def greater(column: str, bound: float) -> Rule:
    return Rule(column, f"gt({bound})", F.col(column) > bound)


def at_least(column: str, bound: float) -> Rule:
    return Rule(column, f"ge({bound})", F.col(column) >= bound)


def validate(df: DataFrame, rule_set: RuleSet) -> DataFrame:
    """(schema_name, column, rule, violations) for every rule, broken or not.

    All row rules are counted in one pass over the whole table; each unique key adds one aggregation and
    reports the number of keys that occur more than once. A missing column is reported, not raised.
    """
    present = set(df.columns)
    counts: list[tuple[str, str, Column]] = []
    for name, wanted in rule_set.types.items():
        counts.append((name, "column_exists", F.lit(0 if name in present else 1).cast("long")))
        if name not in present:
            continue
        cast = F.col(f"`{name}`").try_cast(wanted)
        counts.append((name, f"is_{wanted}", F.count_if(F.col(f"`{name}`").isNotNull() & cast.isNull())))
        if name in rule_set.required:
            counts.append((name, "not_null", F.count_if(F.col(f"`{name}`").isNull())))
    for rule in rule_set.rules:
        if rule.column in present:
            counts.append((rule.column, rule.name, F.count_if(~rule.holds)))
    report = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(r).alias("rule"), F.col(f"v{i}").alias("violations"))
        for i, (c, r, _) in enumerate(counts)
    ])
    result = df.agg(*[
        (F.max(n) if r == "column_exists" else n).alias(f"v{i}") for i, (_, r, n) in enumerate(counts)
    ]).select(F.inline(report))
    result = result.withColumn("violations", F.coalesce("violations", F.lit(0).cast("long")))
    for key in rule_set.unique:
        if set(key) <= present:
            result = result.unionByName(
                duplicate_keys(df, key).select(
                    F.lit(",".join(key)).alias("column"), F.lit("unique").alias("rule"), "violations"
                )
            )
    return result.select(F.lit(rule_set.name).alias("schema_name"), "column", "rule", "violations")


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Number of key values that occur more than once; counted map-side first, so a hot key is one row."""
    return (
        df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).agg(F.count_if(F.col("_n") > 1).alias("violations"))
    )


def rule_sets(
    states: Sequence[str], categories: Sequence[str], weeks=(11101, 11621), years=(2011, 2017), horizon: int = 28
) -> dict[str, RuleSet]:
    """The seven rule sets, fixed values of the published schemas. Ranges and member sets depend on the data set and are parameters."""
    keys = {"id": "string", "date": "date"}
    return {
        "calendar": RuleSet(
            "calendar",
            {
                "date": "date", "wm_yr_wk": "int", "wday": "int", "month": "int", "year": "int", "d": "string",
                "event_name_1": "string", "event_type_1": "string", "event_name_2": "string",
                "event_type_2": "string", **{f"snap_{s}": "int" for s in states},
            },
            ("date", "wm_yr_wk", "wday", "month", "year", "d", *[f"snap_{s}" for s in states]),
            (
                between("wm_yr_wk", *weeks), between("wday", 1, 7), between("month", 1, 12), between("year", *years),
                matches("d", r"^d_\d+$"),
                *[Rule(f"snap_{s}", "in_set", F.col(f"`snap_{s}`").isin(0, 1)) for s in states],
            ),
            (("date",), ("d",)),
        ),
        "sell_prices": RuleSet(
            "sell_prices",
            {"store_id": "string", "item_id": "string", "wm_yr_wk": "int", "sell_price": "double"},
            ("store_id", "item_id", "wm_yr_wk", "sell_price"),
            (greater("sell_price", 0),),
            (("store_id", "item_id", "wm_yr_wk"),),
        ),
        "sales_long": RuleSet(
            "sales_long",
            {
                "id": "string", "item_id": "string", "dept_id": "string", "cat_id": "string", "store_id": "string",
                "state_id": "string", "date": "date", "sales": "double",
            },
            ("id", "item_id", "dept_id", "cat_id", "store_id", "state_id", "date"),
            (one_of("cat_id", categories), one_of("state_id", states), at_least("sales", 0)),
            (("id", "date"),),
        ),
        "features": RuleSet(
            "features",
            {**keys, "sales": "double", "sell_price": "double"},
            ("id", "date"),
            (at_least("sales", 0), greater("sell_price", 0)),
            (("id", "date"),),
        ),
        "predictions": RuleSet(
            "predictions",
            {**keys, "horizon": "int", "prediction": "double", "model_version": "string", "run_id": "string"},
            ("id", "date", "horizon", "prediction", "model_version", "run_id"),
            (between("horizon", 1, horizon), at_least("prediction", 0)),
            (("id", "date"),),
        ),
        "weather": RuleSet(
            "weather",
            {
                "state_id": "string", "date": "date", "temperature_2m_mean": "double",
                "precipitation_sum": "double", "source": "string",
            },
            ("state_id", "date", "source"),
            (one_of("state_id", states), between("temperature_2m_mean", -60, 60), at_least("precipitation_sum", 0)),
            (("state_id", "date"),),
        ),
        "holidays": RuleSet(
            "holidays",
            {
                "date": "date", "country_code": "string", "subdivision": "string", "holiday_name": "string",
                "is_public_holiday": "boolean",
            },
            ("date", "country_code", "holiday_name", "is_public_holiday"),
        ),
    }


def invariants(enriched: DataFrame, stage, key: Sequence[str] = ("id", "date")) -> DataFrame:
    """(check_name, violations) over the whole enriched panel: one pass for rows, one aggregation for keys.

    Distinct days are counted through a grouping, combined map-side, not as sets in one task; `stage` stores its row a day.
    A `key` of the columns that the panel is hashed by, in place of the series' label, is counted without a shuffle.
    """
    sales, price = F.col("sales"), F.col("sell_price")
    by_day = stage(enriched.groupBy("date").agg(
        F.count_if(sales < 0).alias("negative_sales"),
        F.count_if(sales.isNull()).alias("unknown"),
        F.count(sales).alias("known"),
        F.count_if((sales > 0) & price.isNull()).alias("sales_without_price"),
        F.count_if(price <= 0).alias("non_positive_price"),
    ), "by_day")
    # one row per day from here on
    last_fact = by_day.filter(F.col("known") > 0).agg(F.max("date")).scalar()
    rows = (
        by_day.withColumn("last_fact", last_fact)
        .agg(
            F.sum("negative_sales").alias("negative_sales"),
            F.coalesce(F.sum(F.when(F.col("date") <= F.col("last_fact"), F.col("unknown"))), F.lit(0))
            .alias("missing_facts"),
            (F.datediff(F.max("date"), F.min("date")) + 1 - F.count(F.lit(1))).cast("long").alias("calendar_holes"),
            F.sum("sales_without_price").alias("sales_without_price"),
            F.sum("non_positive_price").alias("non_positive_price"),
        )
    )
    names = ["negative_sales", "missing_facts", "calendar_holes", "sales_without_price", "non_positive_price"]
    checks = rows.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("check_name"), F.col(n).alias("violations")) for n in names
    ])))
    duplicates = duplicate_keys(enriched, key).select(
        F.lit("duplicate_id_date").alias("check_name"), "violations"
    )
    return checks.unionByName(duplicates)


def calendar_gaps_by_series(rows: DataFrame) -> DataFrame:
    """Missing days inside each series: a gap would silently shift every row-based lag."""
    return (
        rows.groupBy("id", "date").agg(F.lit(1).alias("_d"))
        .groupBy("id")
        .agg(
            F.min("date").alias("first_day"), F.max("date").alias("last_day"),
            (F.datediff(F.max("date"), F.min("date")) + 1 - F.count(F.lit(1))).cast("long").alias("missing_days"),
        )
    )


def leakage_guard(mart: DataFrame, as_of: date) -> DataFrame:
    """Latest day with a target and whether it respects `as_of`."""
    return mart.agg(F.max(F.when(F.col("sales").isNotNull(), F.col("date"))).alias("max_target_date")).select(
        "max_target_date",
        F.lit(as_of).alias("as_of"),
        F.coalesce(F.col("max_target_date") <= F.lit(as_of), F.lit(True)).alias("no_leakage"),
    )


def leakage_stability(mart: DataFrame, altered: DataFrame, features: Sequence[str], as_of: date) -> DataFrame:
    """Rows up to `as_of` + the lag whose features change when later sales change; there must be none.

    Rows are compared by key through a hash of the features, so only 8 bytes per row meet in the join.
    """
    def hashed(df: DataFrame, name: str) -> DataFrame:
        return df.select("id", "date", F.xxhash64(*features).alias(name))

    both = hashed(mart, "_before").join(hashed(altered, "_after"), ["id", "date"], "full")
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~F.col("_before").eqNullSafe(F.col("_after"))).alias("n_changed"),
    ).withColumn("as_of", F.lit(as_of))


def lag_audit(features: DataFrame, panel: DataFrame, shift: int = 28, width: int = 7) -> DataFrame:
    """Recompute the lag and the rolling mean by dates instead of row offsets and compare.

    The lag comes from an equi join on the shifted date, the mean from a range frame over day numbers.
    """
    from shelfcast.functions.columns import SERIES
    from pyspark.sql import Window

    day = F.unix_date("date")
    by_date = Window.partitionBy(*SERIES).orderBy("_day").rangeBetween(-(shift + width - 1), -shift)
    means = (
        panel.withColumn("_day", day)
        .withColumn("mean_by_date", F.avg("sales").over(by_date))
        .select(*SERIES, "date", "mean_by_date")
    )
    lagged = panel.select(*SERIES, F.date_add("date", shift).alias("date"), F.col("sales").alias("lag_by_date"))
    joined = features.join(means, [*SERIES, "date"], "left").join(lagged, [*SERIES, "date"], "left")
    lag_differs = ~F.col(f"sales_lag_{shift}").eqNullSafe(F.col("lag_by_date"))
    mean = F.col(f"roll_mean_{width}")
    mean_differs = (mean.isNull() != F.col("mean_by_date").isNull()) | (
        F.coalesce(F.abs(mean - F.col("mean_by_date")), F.lit(0.0)) > 1e-9
    )
    return joined.groupBy("store_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(lag_differs).alias("lag_mismatches"),
        F.count_if(mean_differs).alias("mean_mismatches"),
    )
