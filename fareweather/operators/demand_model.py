"""Demand forecast: training rows, time split, encoding, forest and metrics."""

from __future__ import annotations


from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fareweather.config import ConditionThresholds, ForestSettings
from fareweather.functions.labels import classify_condition
from fareweather.functions.numeric import exact_avg, exact_sum, round_even
from fareweather.session import ensure_checkpoint_dir

# The model's input and the columns that predictions carry on.
CATEGORIES = ("pickup_borough", "pickup_zone", "weather_condition")
NUMBERS = (
    "pickup_hour",
    "pickup_dayofweek",
    "pickup_month",
    "pickup_day",
    "is_weekend",
    "pickup_location_id",
    "temperature_2m",
    "precipitation",
    "rain",
    "snowfall",
    "wind_speed_10m",
)
FEATURES = CATEGORIES + NUMBERS
TARGET = "total_trips"

_CARRIED = (
    "pickup_date",
    "pickup_hour",
    "pickup_day_name",
    "is_weekend",
    "pickup_location_id",
    "pickup_borough",
    "pickup_zone",
)
_WEATHER = ("temperature_2m", "precipitation", "rain", "snowfall", "wind_speed_10m")


class EmptySplit(ValueError):
    """One side of the time split holds no rows."""


def training_rows(
    hourly_weather: DataFrame, limits: ConditionThresholds = ConditionThresholds()
) -> DataFrame:
    """Zone-hours with a known zone and weather, calendar features, condition.

    The condition is taken before missing numbers become 0. Only the columns in
    use are read from the table.
    """
    known = ["pickup_location_id", "pickup_borough", "pickup_zone", "temperature_2m"]
    rows = (
        hourly_weather.select(*_CARRIED, *_WEATHER, TARGET)
        .filter(F.col(TARGET) >= 0)
        .dropna(subset=known)
    )
    day = F.col("pickup_date").cast("date")
    condition = classify_condition(
        F.col("snowfall"), F.col("rain"), F.col("precipitation"), limits
    )
    rows = rows.withColumns(
        {
            "pickup_date": day,
            "pickup_dayofweek": F.weekday(day).cast("bigint"),
            "pickup_month": F.month(day).cast("bigint"),
            "pickup_day": F.dayofmonth(day).cast("bigint"),
            "weather_condition": condition,
            "is_weekend": F.col("is_weekend").cast("int").cast("bigint"),
        }
    )
    return rows.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in _WEATHER})


def time_split(rows: DataFrame, split_date: str) -> tuple[DataFrame, DataFrame]:
    """Rows before the date, and rows from the date on."""
    date = F.lit(split_date).cast("date")
    return rows.filter(F.col("pickup_date") < date), rows.filter(F.col("pickup_date") >= date)


def require_both(train: DataFrame, test: DataFrame) -> None:
    if train.isEmpty() or test.isEmpty():
        raise EmptySplit("the split date leaves one side empty")


def fit_codes(train: DataFrame) -> StringIndexerModel:
    """Codes of the categories in alphabetical order, learned in one pass."""
    return StringIndexer(
        inputCols=list(CATEGORIES),
        outputCols=[f"{c}_code" for c in CATEGORIES],
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    ).fit(train)


def _code_steps(codes: StringIndexerModel) -> list:
    """Indexer, then -1 for values unseen in training.

    The indexer gives unseen values the code after the last. Rewriting it also
    drops the nominal metadata, so the forest treats codes as ordered numbers.
    """
    cases = ", ".join(
        f"CASE WHEN {c}_code >= {len(labels)} THEN -1D ELSE {c}_code END AS {c}_ordinal"
        for c, labels in zip(CATEGORIES, codes.labelsArray)
    )
    return [codes, SQLTransformer(statement=f"SELECT *, {cases} FROM __THIS__")]


def encode(codes: StringIndexerModel, rows: DataFrame) -> DataFrame:
    for step in _code_steps(codes):
        rows = step.transform(rows)
    return rows.drop(*[f"{c}_code" for c in CATEGORIES])


def fit_forest(train: DataFrame, settings: ForestSettings = ForestSettings()) -> PipelineModel:
    """Random forest over coded categories and plain numbers.

    The fit runs on executors. Node ids are cached and checkpointed because the
    trees are deep; more memory per iteration means fewer passes.
    """
    ensure_checkpoint_dir(train.sparkSession)
    codes = fit_codes(train)
    inputs = [f"{c}_ordinal" for c in CATEGORIES] + list(NUMBERS)
    steps = _code_steps(codes) + [VectorAssembler(inputCols=inputs, outputCol="features")]
    ready = train
    for step in steps:
        ready = step.transform(ready)
    forest = RandomForestRegressor(
        featuresCol="features",
        labelCol=TARGET,
        predictionCol="raw_prediction",
        numTrees=settings.trees,
        maxDepth=settings.max_depth,
        minInstancesPerNode=settings.min_leaf,
        featureSubsetStrategy="all",
        maxBins=settings.max_bins,
        seed=settings.seed,
        cacheNodeIds=True,
        checkpointInterval=10,
        maxMemoryInMB=1024,
    )
    # The fit passes over these rows dozens of times, so they are spread first; the
    # small input files alone would keep most cores idle. Which rows a tree draws
    # follows from their partition and place, so both come from the rows' content
    # and the settings, never from the machine.
    points = (
        ready.select("features", TARGET, F.xxhash64(*[F.col(c) for c in train.columns]).alias("_row"))
        .repartition(settings.parts(train.count()), "_row")
        .sortWithinPartitions("_row")
        .select("features", TARGET)
        .persist()
    )
    try:
        model = forest.fit(points)
    finally:
        points.unpersist()
    return PipelineModel(stages=[*steps, model])


def predict(model: PipelineModel, test: DataFrame) -> DataFrame:
    scored = model.transform(test).withColumn("predicted_total_trips", F.col("raw_prediction"))
    return as_predictions(scored)


def as_predictions(scored: DataFrame) -> DataFrame:
    """Floor at 0, keep the unrounded value for metrics, round, add errors."""
    exact = F.greatest(F.col("predicted_total_trips"), F.lit(0.0))
    rounded = round_even(exact, 2)
    error = F.col(TARGET) - rounded
    return scored.select(
        *_CARRIED,
        "weather_condition",
        *_WEATHER,
        TARGET,
        exact.alias("exact_prediction"),
        rounded.alias("predicted_total_trips"),
        error.alias("prediction_error"),
        F.abs(error).alias("absolute_error"),
    )


def published(predictions: DataFrame) -> DataFrame:
    return predictions.drop("exact_prediction")


def mape(actual: Column, predicted: Column) -> Column:
    """Mean absolute percentage error over non-zero actuals, 0 without any."""
    share = F.when(actual != 0, F.abs(F.try_divide(actual - predicted, actual)))
    return F.coalesce(exact_avg(share) * 100.0, F.lit(0.0))


def error_metrics(predictions: DataFrame, predicted: str = "exact_prediction") -> DataFrame:
    """MAE, RMSE, R2 and MAPE in one aggregation.

    All sums are exact, so the figures are equal to the bit for any layout of the rows.
    The spread of the actual values is n times the sum of their squares less the square
    of their sum, both as whole numbers.
    """
    actual = f"CAST({TARGET} AS DOUBLE)"
    error = f"({actual} - `{predicted}`)"
    whole = f"CAST({TARGET} AS DECIMAL(18,0))"
    squares, total = f"sum({whole} * {whole})", f"CAST(sum({whole}) AS DECIMAL(18,0))"
    spread = f"CAST(count({TARGET}) AS DECIMAL(18,0)) * CAST({squares} AS DECIMAL(20,0)) - {total} * {total}"
    return predictions.agg(
        F.count(F.lit(1)).alias("test_rows"),
        exact_avg(f"abs({error})").alias("mae"),
        F.sqrt(exact_avg(f"{error} * {error}")).alias("rmse"),
        (F.lit(1.0) - F.try_divide(exact_sum(f"{error} * {error}"), F.expr(f"CAST({spread} AS DOUBLE) / count({TARGET})"))).alias("r2"),
        mape(F.col(TARGET).cast("double"), F.col(predicted)).alias("mape_percent"),
    )


def mean_predictions(train: DataFrame, test: DataFrame) -> DataFrame:
    """The training mean as prediction of every test row."""
    mean = train.agg(exact_avg(TARGET)).scalar()
    return as_predictions(test.withColumn("predicted_total_trips", mean))


def mean_baseline(train: DataFrame, test: DataFrame) -> DataFrame:
    metrics = error_metrics(mean_predictions(train, test))
    return metrics.select(
        F.col("mae").alias("baseline_mean_mae"), F.col("rmse").alias("baseline_mean_rmse")
    )


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """One row per feature, most important first."""
    forest = model.stages[-1]
    assert isinstance(forest, RandomForestRegressionModel)
    one = spark.createDataFrame([(forest.featureImportances,)], ["importances"])
    names = F.array(*[F.lit(f) for f in FEATURES])
    pairs = F.arrays_zip(
        names.alias("feature"), vector_to_array("importances").alias("importance")
    )
    return (
        one.select(F.explode(pairs).alias("pair"))
        .select(
            F.col("pair")["feature"].alias("feature"),
            F.col("pair")["importance"].alias("importance"),
        )
        .orderBy(F.desc("importance"), "feature")
    )
