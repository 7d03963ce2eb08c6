"""Train and score one model per group: rows to metrics and a submission."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from types import MappingProxyType

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermopanel import rules
from thermopanel.functions import calendar as cal
from thermopanel.functions import weather
from thermopanel.models import metrics, splits, train
from thermopanel.operators import cleaning, decompose, joins, lags
from thermopanel.operators.series import IDX, LEN, SITE_HOURS
from thermopanel.session import materialise

SEASON_NAMES = ("winter", "spring", "summer", "autumn")


@dataclass(frozen=True)
class Options:
    """``split`` is 'random' or 'time'; ``models`` maps a name to booster parameters.

    With ``trials`` a search over expanding time folds of each group's training rows adds a model ``tuned``; ``limits`` bound what
    it may draw. ``patience`` turns on early stopping on the held-out rows of the validation run.
    """

    split: str = "random"
    holdout: tuple[str, str] = ("2023-07-01 01:00:00", "2023-12-31 23:00:00")
    share: float = 0.2
    models: Mapping[str, Mapping] = field(default_factory=lambda: {"GBT": {}})
    keys: Sequence[str] = rules.CLUSTER_KEYS
    split_summer: bool = True
    target: str = "heat_demand"
    trials: int = 0
    limits: Mapping = field(default_factory=dict)
    patience: int | None = None


def hourly_features(raw: DataFrame) -> DataFrame:
    """Feature set of the training job, taken before any split so that lags see real hours."""
    df = cleaning.drop_null_target(cleaning.sentinel_to_null(raw))
    tm = F.col("tm")
    df = df.withColumns({
        "date": F.to_date(tm), "year": F.year(tm), "month": F.month(tm), "day": F.dayofmonth(tm), "hour": F.hour(tm),
        "day_mod7": cal.day_mod7(F.dayofmonth(tm)), "season": cal.season(F.month(tm), SEASON_NAMES),
        "wd_group": weather.wind_sector4(null_label="N"),
        "ws_group": weather.wind_speed_class(null_label=weather.WIND_CLASSES[-1]),
        **weather.wind_vector(), "dew_point": weather.dew_point(), **cal.cyclical_parts(),
    })
    # daily tables first, from the rows themselves: they are small, one row per calendar day
    daily = decompose.additive_decomposition(decompose.daily_mean(df, "ta"), "ta", 30).drop("ta")
    flags = joins.daily_night_flags(df)
    df = joins.join_daily(joins.join_daily(df, flags), daily)
    short = {c: lags.SHORT_LAG_HOURS for c in lags.SHORT_LAG_COLUMNS}
    source = cleaning.drop_null_target(cleaning.sentinel_to_null(raw))
    laid = SITE_HOURS.blocks(df, before=max(lags.SHORT_LAG_HOURS), source=source)
    w = SITE_HOURS.window()
    laid = laid.select("*", *lags.lag_exprs(w, short, "{c}_lag_{n}"))
    means = {f"{c}_ma": (c, -2, 0) for c in lags.AVERAGE_COLUMNS}
    return SITE_HOURS.own_rows(lags.with_frame_means(laid, w, means)).drop("date", IDX, LEN)


def with_groups(df: DataFrame, options: Options) -> DataFrame:
    return splits.with_cluster_key(joins.with_cluster(df), options.split_summer).drop("cluster_id")


def with_holdout(df: DataFrame, options: Options) -> DataFrame:
    if options.split == "random":
        return splits.hash_holdout(df, share=options.share)
    if options.split == "time":
        return splits.time_holdout(df, *options.holdout)
    raise ValueError(f"unknown split {options.split!r}")


def learning_rows(rows: DataFrame, options: Options) -> DataFrame:
    return cleaning.valid_target(rows, options.target).withColumn("heat_demand_log", F.log1p(options.target))


def of_groups(df: DataFrame, options: Options) -> dict[str, DataFrame]:
    return {key: df.filter(F.col("cluster_key") == key) for key in options.keys}


def tune(rows: DataFrame, options: Options) -> dict[str, Mapping]:
    """Best parameters per group, searched over expanding time folds; empty without trials."""
    if not options.trials:
        return {}
    parts = of_groups(learning_rows(rows, options), options)
    folded = {key: splits.expanding_folds(part) for key, part in parts.items() if not part.isEmpty()}
    found = train.tune_groups(folded, trials=options.trials, ranges=train.CV_SEARCH_RANGES, limits=options.limits)
    return {key: search.best for key, search in found.items()}


def models_of(options: Options, tuned: Mapping[str, Mapping]) -> dict[str, tuple[Mapping, Mapping]]:
    """name -> (parameters for all groups, parameters of single groups)."""
    out = {name: (params, {}) for name, params in options.models.items()}
    return out | ({"tuned": ({}, tuned)} if tuned else {})


def validate(rows: DataFrame, options: Options, tuned: Mapping[str, Mapping] = MappingProxyType({})) -> DataFrame:
    """Validation predictions of every group and model, on the demand scale."""
    marked = of_groups(with_holdout(learning_rows(rows, options), options), options)
    held = {key: part.filter("is_valid").drop("is_valid") for key, part in marked.items()}
    stop = options.patience is not None
    frames = marked if stop else {key: part.filter("NOT is_valid").drop("is_valid") for key, part in marked.items()}
    models = train.fit_models(frames, models_of(options, tuned), early_stop=stop, patience=options.patience or train.PATIENCE)
    return train.predict_models(models, held)


def score_test(
    rows: DataFrame, test: DataFrame, options: Options, tuned: Mapping[str, Mapping] = MappingProxyType({}),
) -> DataFrame:
    """Fit on all training rows and predict the test rows: (cluster_key, model, id, tm, ...)."""
    fit = of_groups(learning_rows(rows, options), options)
    new = of_groups(test.withColumn("heat_demand_log", F.log1p(options.target)), options)
    return train.predict_models(train.fit_models(fit, models_of(options, tuned)), new)


def run(train_raw: DataFrame, test_raw: DataFrame, submission: DataFrame, options: Options = Options()) -> dict[str, DataFrame]:
    """Validation metrics per group and model, pooled metrics of the best, and the submission.

    Every model passes over the feature rows again, so they are written out once.
    """
    rows = materialise(with_groups(hourly_features(train_raw), options))
    test = materialise(with_groups(hourly_features(test_raw), options))
    tuned = tune(rows, options)
    validated = validate(rows, options, tuned)
    predicted = score_test(rows, test, options, tuned)
    mean = metrics.ensemble_mean(predicted, ("id",)).withColumnRenamed("prediction", options.target)
    scores = metrics.regression_metrics(validated, ["cluster_key", "model"])
    return {
        "validated": validated,
        "metrics": scores,
        "best": metrics.overall_best(scores),
        "global_metrics": metrics.pooled_best_metrics(validated),
        "predictions": predicted,
        "submission": joins.fill_submission(submission, mean, options.target),
    }
