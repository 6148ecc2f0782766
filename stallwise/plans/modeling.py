"""Late-delivery model: preparation, logistic regression, scoring, evaluation. Fitting is Spark ML."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stallwise import contract
from stallwise.functions import columns as fn
from stallwise.operators import classification, drift, splits
from stallwise.plans.features import coerce_features, validate_columns
from stallwise.session import durable, fresh_path
from stallwise.sources import sinks

POOLED = "infrequent"
TIME = "order_purchase_timestamp"


def numeric_statistics(train: DataFrame, features: list[str] = contract.NUMERIC_FEATURES) -> DataFrame:
    """(feature, median, mean, scale): exact median, then mean and population deviation after imputing it.

    Medians come from running counts per distinct value instead of a buffer with all values. Mean and
    deviation of the present values take one wide aggregate; the imputed rows are added in closed form.
    """
    counts = (
        drift.long_values(train, features, fn.lenient_double)
        .where(fn.defined(F.col("value")))
        .groupBy("feature", "value")
        .agg(F.count("*").alias("baseline_n"))
    )
    medians = drift.quantiles(drift.with_ranks(counts), 2).where("part = 1").select(
        "feature", F.col("edge").alias("median")
    )
    present = {c: F.when(fn.defined(number), number) for c in features for number in [fn.lenient_double(F.col(c))]}
    moments = train.agg(
        F.count("*").alias("n"),
        *[F.count(v).alias(f"n_{c}") for c, v in present.items()],
        *[F.avg(v).alias(f"mean_{c}") for c, v in present.items()],
        *[F.var_pop(v).alias(f"var_{c}") for c, v in present.items()],
    )
    per_feature = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.col(f"n_{c}").alias("n_present"),
                F.coalesce(f"mean_{c}", F.lit(0.0)).alias("present_mean"),
                F.coalesce(f"var_{c}", F.lit(0.0)).alias("present_var"),
            )
            for c in features
        ]
    )
    median, mean = F.coalesce("median", F.lit(0.0)), F.col("mean")
    n_imputed = F.col("n") - F.col("n_present")
    combined_mean = (F.col("n_present") * F.col("present_mean") + n_imputed * median) / F.col("n")
    spread = F.col("n_present") * (F.col("present_var") + F.pow(F.col("present_mean") - mean, F.lit(2)))
    variance = (spread + n_imputed * F.pow(median - mean, F.lit(2))) / F.col("n")
    return (
        moments.select("n", F.inline(per_feature))
        .join(medians, "feature", "left")
        .withColumn("mean", combined_mean)
        .select(
            "feature",
            median.alias("median"),
            "mean",
            F.when(variance > 0, F.sqrt(variance)).otherwise(F.lit(1.0)).alias("scale"),
        )
    )


def standardized(c: Column, median: float, mean: float, scale: float) -> Column:
    number = F.when(fn.defined(c), c).otherwise(F.lit(median))
    return (number - F.lit(mean)) / F.lit(scale)


def category_vocabulary(
    train: DataFrame,
    features: list[str] = contract.CATEGORICAL_FEATURES,
    max_outputs: int = contract.MAX_CATEGORIES,
) -> DataFrame:
    """(feature, category, n_rows, slot): every training category and its one-hot slot.

    With fewer than ``max_outputs`` categories each has its own slot, in name order. Otherwise the most
    frequent ``max_outputs - 1`` keep one, later names first on a tie, and the rest share the last slot.
    """
    # stored once: ranking, sizes and the table itself read them
    counts = durable(
        drift.long_values(
            train, features, lambda c: fn.default_if_null(c.cast("string"), contract.MISSING_CATEGORY)
        )
        .groupBy("feature", F.col("value").alias("category"))
        .agg(F.count("*").alias("n_rows"))
    )
    by_frequency = Window.partitionBy("feature").orderBy(F.col("n_rows").desc(), F.col("category").desc())
    # the kept rows are at most max_outputs per feature; map-side ranking cuts before the shuffle
    leading = (
        counts.withColumn("position", F.row_number().over(by_frequency))
        .where(F.col("position") <= max_outputs)
    )
    by_name = Window.partitionBy("feature").orderBy("category")
    sizes = leading.groupBy("feature").agg(F.max("position").alias("n_leading"))
    kept = (
        leading.join(F.broadcast(sizes), "feature")
        .where((F.col("n_leading") < max_outputs) | (F.col("position") < max_outputs))
        .select("feature", "category", (F.row_number().over(by_name) - 1).alias("slot"))
    )
    return counts.join(F.broadcast(kept), ["feature", "category"], "left").select(
        "feature", "category", "n_rows", F.coalesce("slot", F.lit(max_outputs - 1)).cast("int").alias("slot")
    )


def slot_labels(vocabulary: DataFrame, max_outputs: int = contract.MAX_CATEGORIES) -> dict[str, list[str]]:
    """Slot names per feature, at most ``max_outputs`` each."""
    rows = (
        vocabulary.groupBy("feature", "slot")
        .agg(F.min("category").alias("category"))
        .orderBy("feature", "slot")
        .collect()
    )
    labels: dict[str, list[str]] = {}
    for row in rows:
        pooled = row["slot"] == max_outputs - 1
        labels.setdefault(row["feature"], []).append(POOLED if pooled else row["category"])
    return labels


@dataclass(frozen=True)
class LinearModel:
    """What scoring needs: bounded statistics and coefficients on the driver, the vocabulary as a table."""

    version: str
    numeric: dict[str, tuple[float, float, float]]
    labels: dict[str, list[str]]
    vocabulary: DataFrame
    train_rows: int
    coefficients: list[float]
    intercept: float

    def input_names(self) -> list[str]:
        return input_names(self.labels)

    def linear(self) -> LinearModel:
        return self

    def encoded(self, features: DataFrame) -> DataFrame:
        return encode(features, self.numeric, self.labels, self.vocabulary)

    def probability(self) -> Column:
        """Of an encoded row: terms are added in the order of the inputs, so every engine gets the same sum."""
        total, at = F.lit(float(self.intercept)), 0
        for c in contract.NUMERIC_FEATURES:
            total, at = total + F.lit(float(self.coefficients[at])) * F.col(f"_n_{c}"), at + 1
        for c in contract.CATEGORICAL_FEATURES:
            n = len(self.labels[c])
            # the place after the last slot stands for categories not seen in training
            weights = F.array(*[F.lit(float(w)) for w in self.coefficients[at : at + n]], F.lit(0.0))
            total, at = total + F.element_at(weights, F.col(f"_c_{c}").cast("int") + 1), at + n
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def input_names(labels: dict[str, list[str]]) -> list[str]:
    return [*contract.NUMERIC_FEATURES, *[f"{f}={label}" for f in contract.CATEGORICAL_FEATURES for label in labels[f]]]


@dataclass(frozen=True)
class DelayModel:
    """A fitted model: bounded statistics on the driver, the vocabulary as a table, Spark ML stages."""

    version: str
    numeric: dict[str, tuple[float, float, float]]
    labels: dict[str, list[str]]
    vocabulary: DataFrame
    stages: PipelineModel
    train_rows: int

    @property
    def classifier(self):
        return self.stages.stages[-1]

    def input_names(self) -> list[str]:
        return input_names(self.labels)

    def linear(self) -> LinearModel:
        fitted = self.classifier
        return LinearModel(
            self.version, self.numeric, self.labels, self.vocabulary, self.train_rows, [float(w) for w in fitted.coefficients], float(fitted.intercept)
        )

    def encoded(self, features: DataFrame) -> DataFrame:
        return encode(features, self.numeric, self.labels, self.vocabulary)


# Rows of one category outside the kept ones meet its vocabulary row in so many tasks.
SPREAD = 16


def encode(
    features: DataFrame,
    numeric: dict[str, tuple[float, float, float]],
    labels: dict[str, list[str]],
    vocabulary: DataFrame,
) -> DataFrame:
    """Adds scaled numbers and one-hot slots. A category not seen in training gets the slot that is dropped.

    Kept categories are looked up in a literal map of at most 40 entries. Only where the last slot is shared do the
    others have to be told from unseen ones, by a join with their vocabulary; rows of kept categories take part in it with
    keys of their own that meet nothing, and those of one other category are spread over ``SPREAD`` keys, so no key is hot.
    """
    df = coerce_features(validate_columns(features))
    df = df.withColumns({f"_n_{c}": standardized(F.col(c), *numeric[c]) for c in contract.NUMERIC_FEATURES})
    spread = F.xxhash64(*[F.col(f"_n_{c}") for c in contract.NUMERIC_FEATURES], "order_id")
    for c in contract.CATEGORICAL_FEATURES:
        unseen = len(labels[c])
        attribute = {"ml_attr": {"type": "nominal", "name": c, "vals": [*labels[c], "(unseen)"]}}
        shared = unseen == contract.MAX_CATEGORIES
        kept = labels[c][:-1] if shared else labels[c]
        slot = F.try_element_at(literal_map(kept), F.col(c))
        if shared:
            others = (
                vocabulary.where((F.col("feature") == c) & (F.col("slot") == unseen - 1))
                .select(F.col("category").alias("_other"), F.explode(F.expr(f"sequence(0L, {SPREAD - 1}L)")).alias("_part"))
            )
            df = df.withColumns({"_slot": slot, "_key": F.when(slot.isNull(), F.col(c)).otherwise(F.lit("")),
                                 "_lane": F.when(slot.isNull(), F.pmod(spread, F.lit(SPREAD))).otherwise(-1 - F.pmod(spread, F.lit(2**40)))})
            df = df.join(others, (F.col("_key") == F.col("_other")) & (F.col("_lane") == F.col("_part")), "left")
            slot = F.coalesce("_slot", F.when(F.col("_other").isNotNull(), F.lit(unseen - 1)))
        encoded = F.coalesce(slot, F.lit(unseen)).cast("double").alias(f"_c_{c}", metadata=attribute)
        df = df.withColumn(f"_c_{c}", encoded).drop("_slot", "_key", "_lane", "_other", "_part")
    return df


def literal_map(categories: list[str]) -> Column:
    """Category to its place, as a literal."""
    if not categories:
        return F.lit(None).cast("map<string,int>")
    return F.create_map(*[part for i, name in enumerate(categories) for part in (F.lit(name), F.lit(i))])


def fit(train: DataFrame, version: str, max_iter: int = contract.MAX_ITERATIONS) -> DelayModel:
    """L2 logistic regression with unit strength on the summed loss, intercept free.

    Spark divides the loss by the number of rows, so unit strength is a penalty of 1/rows.
    """
    statistics = {r["feature"]: (r["median"], r["mean"], r["scale"]) for r in numeric_statistics(train).collect()}
    vocabulary = category_vocabulary(train)
    spark = train.sparkSession
    vocabulary = sinks.overwrite(vocabulary, fresh_path(spark, "vocabulary"))
    labels = slot_labels(vocabulary)
    rows = train.count()
    # stored once: every iteration of the fit reads these rows, not the joins that made them
    encoded = sinks.overwrite(encode(train, statistics, labels, vocabulary), fresh_path(spark, "encoded"))
    cats = contract.CATEGORICAL_FEATURES
    vectors = [f"_v_{c}" for c in cats]
    pipeline = Pipeline(
        stages=[
            OneHotEncoder(inputCols=[f"_c_{c}" for c in cats], outputCols=vectors, dropLast=True),
            VectorAssembler(
                inputCols=[*[f"_n_{c}" for c in contract.NUMERIC_FEATURES], *vectors], outputCol="inputs"
            ),
            LogisticRegression(
                featuresCol="inputs",
                labelCol="_label",
                maxIter=max_iter,
                regParam=1.0 / rows,
                elasticNetParam=0.0,
                standardization=False,
            ),
        ]
    )
    stages = pipeline.fit(encoded.withColumn("_label", F.col(contract.LABEL).cast("double")))
    # the training summary holds on to the session, which tasks could not carry once anything was observed in it
    stages.stages[-1]._java_obj.setSummary(spark._jvm.scala.Option.empty())
    return DelayModel(version, statistics, labels, vocabulary, stages, rows)


def save(model: DelayModel | LinearModel, path: str) -> str:
    """Writes the model under ``path``/``version``; each part is a Spark table or Spark ML artefact."""
    spark = model.vocabulary.sparkSession
    base = f"{path.rstrip('/')}/{model.version}"
    if isinstance(model, DelayModel):
        model.stages.write().overwrite().save(f"{base}/stages")
    model.vocabulary.write.mode("overwrite").parquet(f"{base}/vocabulary")
    rows = [(f, *values, model.train_rows) for f, values in model.numeric.items()]
    spark.createDataFrame(
        rows, "feature string, median double, mean double, scale double, train_rows bigint"
    ).coalesce(1).write.mode("overwrite").parquet(f"{base}/numeric")
    coefficient_table(model).coalesce(1).write.mode("overwrite").parquet(f"{base}/coefficients")
    return base


INTERCEPT = "(intercept)"


def coefficient_table(model: DelayModel | LinearModel) -> DataFrame:
    """(position, feature, coefficient) in the order of the inputs, the intercept last."""
    linear = model.linear()
    pairs = [*zip(linear.input_names(), linear.coefficients), (INTERCEPT, linear.intercept)]
    rows = [(at, name, float(value)) for at, (name, value) in enumerate(pairs)]
    return linear.vocabulary.sparkSession.createDataFrame(rows, "position int, feature string, coefficient double")


def stored_parts(spark: SparkSession, base: str) -> tuple[DataFrame, dict[str, tuple[float, float, float]], int]:
    """Vocabulary, statistics per number and training rows of a saved model."""
    vocabulary = spark.read.parquet(f"{base}/vocabulary")
    repeated = vocabulary.groupBy("feature", "category").count().where("count > 1").first()
    if repeated is not None:
        raise ValueError(f"category {repeated['category']} of {repeated['feature']} has two slots")
    numeric = spark.read.parquet(f"{base}/numeric").collect()
    return vocabulary, {r["feature"]: (r["median"], r["mean"], r["scale"]) for r in numeric}, numeric[0]["train_rows"]


def load(spark: SparkSession, path: str, version: str) -> DelayModel:
    base = f"{path.rstrip('/')}/{version}"
    vocabulary, numeric, train_rows = stored_parts(spark, base)
    return DelayModel(version, numeric, slot_labels(vocabulary), vocabulary, PipelineModel.load(f"{base}/stages"), train_rows)


def load_linear(spark: SparkSession, path: str, version: str) -> LinearModel:
    """The model from its tables alone, for scoring."""
    base = f"{path.rstrip('/')}/{version}"
    vocabulary, numeric, train_rows = stored_parts(spark, base)
    values = [r["coefficient"] for r in spark.read.parquet(f"{base}/coefficients").orderBy("position").collect()]
    return LinearModel(version, numeric, slot_labels(vocabulary), vocabulary, train_rows, values[:-1], values[-1])


def score(model: DelayModel | LinearModel, features: DataFrame, stamp: Column | None = None) -> DataFrame:
    """One prediction per feature row, labelled or not; the lookups are unique, so rows neither drop nor repeat."""
    linear = model.linear()
    return linear.encoded(features).select("order_id", linear.probability().alias("predicted_probability")).select(
        "order_id",
        "predicted_probability",
        fn.predicted_class(F.col("predicted_probability")).alias("predicted_class"),
        F.lit(model.version).alias("model_version"),
        (stamp if stamp is not None else F.current_timestamp()).alias("prediction_timestamp"),
    )


def optimality(model: DelayModel, train: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """(feature, gradient, optimal) per input and for the intercept: the slope of the penalised loss at the fitted weights,
    per training row, and whether it is zero within ``tolerance``.

    The loss is the summed log loss plus half the squared weights, the intercept free. One pass over the training rows.
    """
    linear = model.linear()
    label = F.col(contract.LABEL).cast("double")
    rows = linear.encoded(train.where(F.col(contract.LABEL).isNotNull())).withColumn("_miss", linear.probability() - label)
    slopes = [F.sum(F.col("_miss") * F.col(f"_n_{c}")) for c in contract.NUMERIC_FEATURES]
    slopes += [F.sum(F.when(F.col(f"_c_{c}") == slot, F.col("_miss"))) for c in contract.CATEGORICAL_FEATURES for slot in range(len(linear.labels[c]))]
    weights = [*linear.coefficients, 0.0]
    names = [*linear.input_names(), INTERCEPT]
    summed = rows.agg(F.count("*").alias("n"), *[F.coalesce(slope, F.lit(0.0)).alias(f"g{i}") for i, slope in enumerate([*slopes, F.sum("_miss")])])
    entries = [F.struct(F.lit(name).alias("feature"), ((F.col(f"g{i}") + F.lit(float(weights[i]))) / F.col("n")).alias("gradient")) for i, name in enumerate(names)]
    return summed.select(F.inline(F.array(*entries))).withColumn("optimal", F.abs("gradient") <= F.lit(tolerance))


def store_scores(model: DelayModel | LinearModel, features: DataFrame, path: str, stamp: Column | None = None) -> DataFrame:
    """Writes one prediction per feature row; another number of rows than was read is an error."""
    stored = sinks.overwrite(score(model, features, stamp), path)
    read, written = features.count(), stored.count()
    if read != written:
        raise ValueError(f"{read} rows to score, but {written} predictions")
    return stored


def score_dry_run(model: DelayModel | LinearModel, features: DataFrame) -> DataFrame:
    """(n_input, n_scored): runs the scoring and writes nothing."""
    scored = score(model, features).agg(
        F.count("predicted_probability").alias("n_scored"), F.max("model_version").alias("model_version")
    )
    return features.agg(F.count("*").alias("n_input")).crossJoin(F.broadcast(scored))


def labelled_scores(model: DelayModel, split: DataFrame) -> DataFrame:
    """(order_id, split, label, probability, class) of labelled rows that carry a split."""
    probability = vector_to_array(F.col("probability"))[1]
    return model.stages.transform(model.encoded(split)).select(
        "order_id",
        "split",
        F.col(contract.LABEL).alias("actual_is_delayed"),
        probability.alias("predicted_probability"),
        fn.predicted_class(probability).alias("predicted_class"),
    )


def evaluate(scored: DataFrame, group: list[str] | None = None) -> DataFrame:
    return classification.quality_report(
        scored, "predicted_probability", "actual_is_delayed", "predicted_class", group
    )


def evaluation_summary(scores: DataFrame, split: DataFrame) -> DataFrame:
    """Per split its size, quality and counts; the training split has a size only."""
    held_out = scores.where(F.col("split") != splits.TRAIN)
    sizes = splits.split_sizes(split).withColumnRenamed("n_rows", "split_rows")
    return sizes.join(evaluate(held_out, ["split"]).drop("n_rows"), "split", "left")


def top_coefficients(model: DelayModel | LinearModel, n: int = 25) -> DataFrame:
    """(feature, coefficient) by absolute size; as many rows as the model has inputs, so bounded."""
    table = coefficient_table(model).where(F.col("feature") != INTERCEPT)
    return table.select("feature", "coefficient").orderBy(F.abs("coefficient").desc(), "feature").limit(n)


def auc_gate(report: DataFrame, minimum: float) -> DataFrame:
    """(roc_auc, minimum_auc, passed); an undefined AUC fails."""
    return report.select(
        "roc_auc",
        F.lit(float(minimum)).alias("minimum_auc"),
        F.coalesce(F.col("roc_auc") >= F.lit(float(minimum)), F.lit(False)).alias("passed"),
    )
