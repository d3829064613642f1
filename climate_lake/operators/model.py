"""Lag features, and random forests on the mean temperature and the precipitation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from climate_lake.functions.columns import season_code
from climate_lake.operators.cleaning import latest_only

MODEL_INPUTS = [
    "temp_lag1",
    "temp_lag2",
    "precipitation",
    "humidity",
    "wind_speed",
    "elevation",
    "day_of_year",
    "season",
]


@dataclass(frozen=True)
class Target:
    """A measure to predict, and the columns it is predicted from."""

    name: str
    label: str
    inputs: tuple[str, ...]


TEMPERATURE = Target("temperature", "temp_avg", tuple(MODEL_INPUTS))
# The measure itself is no input; the mean temperature takes its place.
PRECIPITATION = Target(
    "precipitation",
    "precipitation",
    tuple("temp_avg" if name == "precipitation" else name for name in MODEL_INPUTS),
)


def lag_features(weather: DataFrame) -> DataFrame:
    """Mean temperature of the two preceding entries of the city.

    Repeated fetches are reduced to one row per city and date first, so a
    window holds at most one row per calendar day however often a city was
    fetched.
    """
    by_day = Window.partitionBy("city_name").orderBy("date")
    lags = {f"temp_lag{step}": F.lag("temp_avg", step).over(by_day) for step in (1, 2)}
    return latest_only(weather).withColumns(lags)


def model_rows(weather: DataFrame) -> DataFrame:
    """Lag features with day of year and season."""
    return lag_features(weather).withColumns({"day_of_year": F.dayofyear("date"), "season": season_code()})


def _ready(rows: DataFrame, target: Target, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows with a known label. An absent input is 0 with its indicator set, so no row is lost for it.

    Columns ``keep`` come first, under their names with an underscore before them.
    """
    kept = [F.col(name).alias(f"_{name}") for name in keep]
    filled = [F.coalesce(F.col(name).cast("double"), F.lit(0.0)).alias(name) for name in target.inputs]
    absent = [F.col(name).isNull().cast("double").alias(f"{name}_absent") for name in target.inputs]
    label = F.col(target.label).cast("double").alias("label")
    return rows.filter(F.col(target.label).isNotNull()).select(*kept, label, *filled, *absent)


def vector_inputs(target: Target) -> list[str]:
    """Names of the places of a feature vector."""
    return [*target.inputs, *[f"{name}_absent" for name in target.inputs]]


def feature_stages(target: Target) -> list:
    """Inputs and indicators as one vector, each divided by its deviation in the training rows (0 if that is 0)."""
    return [
        VectorAssembler(inputCols=vector_inputs(target), outputCol="features"),
        StandardScaler(inputCol="features", outputCol="scaled_features"),
    ]


def scaled_features(training: DataFrame, rows: DataFrame, target: Target = TEMPERATURE) -> DataFrame:
    """City, date and the scaled inputs of each row with a label, one column per place of the vector."""
    fitted = Pipeline(stages=feature_stages(target)).fit(_ready(training, target))
    scaled = fitted.transform(_ready(rows, target, ("city_name", "date")))
    values = vector_to_array("scaled_features")
    places = [F.get(values, F.lit(k)).alias(f"scaled_{name}") for k, name in enumerate(vector_inputs(target))]
    return scaled.select(F.col("_city_name").alias("city_name"), F.col("_date").alias("date"), *places)


def with_part(rows: DataFrame, train_tenths: int = 8) -> DataFrame:
    """``training`` is true for the first tenths of the covered time span: no test day precedes a training day."""
    days = F.floor(F.datediff(F.max("date"), F.min("date")) * train_tenths / 10).cast("int")
    # One row is fetched; without rows there is no cut.
    cut = rows.agg(F.date_add(F.min("date"), days).alias("cut")).first()["cut"]
    return rows.withColumn("training", F.coalesce(F.col("date") < F.lit(cut).cast("date"), F.lit(False)))


def split(rows: DataFrame, train_tenths: int = 8) -> tuple[DataFrame, DataFrame]:
    """Training rows and the later test rows."""
    parts = with_part(rows, train_tenths)
    return parts.filter("training").drop("training"), parts.filter(~F.col("training")).drop("training")


def train(
    rows: DataFrame, target: Target = TEMPERATURE, trees: int = 20, depth: int = 5, seed: int = 42
) -> PipelineModel:
    forest = RandomForestRegressor(
        featuresCol="scaled_features", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed
    )
    return Pipeline(stages=[*feature_stages(target), forest]).fit(_ready(rows, target))


def evaluate(model: PipelineModel, rows: DataFrame, target: Target = TEMPERATURE) -> float:
    scored = model.transform(_ready(rows, target))
    return RegressionEvaluator(labelCol="label", metricName="rmse").evaluate(scored)


def predicted(model: PipelineModel, rows: DataFrame, target: Target = TEMPERATURE) -> DataFrame:
    """City, date and month, the measured value and the model's, of each row with a label; a table to be stored."""
    scored = model.transform(_ready(rows, target, ("city_name", "date")))
    return scored.select(
        F.lit(target.name).alias("model"),
        F.col("_city_name").alias("city_name"),
        F.col("_date").alias("date"),
        F.month("_date").alias("month"),
        F.col("label").alias("measured"),
        "prediction",
    )


def prediction_errors(predictions: DataFrame, *keys: str) -> DataFrame:
    """Rows, mean error and root mean square error of stored predictions, as a whole or by ``keys``."""
    error = F.col("prediction") - F.col("measured")
    return predictions.groupBy(*keys).agg(
        F.count("*").alias("rows_used"), F.avg(error).alias("bias"), F.sqrt(F.avg(error * error)).alias("rmse")
    )


def persistence_error(rows: DataFrame) -> DataFrame:
    """Rows, rows with a preceding entry, and the error of predicting a day by that entry."""
    error = F.col("temp_avg") - F.col("temp_lag1")
    return rows.agg(
        F.count("*").alias("rows"),
        F.count(error).alias("rows_used"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
    )
