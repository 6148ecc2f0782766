"""One callable per operator: (spark, sf_dir) -> DataFrame over the driver's tables.

``Data`` derives the raw marketplace tables and everything built from them, lazily. Splits, baselines and
thresholds of the test data are the fixed values below.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import driver_tables
from stallwise import contract
from stallwise.functions import columns as fn
from stallwise.operators import checks, classification, drift, splits
from stallwise.plans import build, features, marts, metrics, modeling, monitoring, quality, retraining
from stallwise.plans import staging
from stallwise.session import fresh_path
from stallwise.sources import catalog, sinks

# Fixed values of the test data.
VALIDATION_START, TEST_START, EXTENDED_END = "1999-01-01", "2000-01-01", "1999-07-01"
AS_OF = "2001-07-01"
BASELINE_AUC = 0.70
RUN_STAMP = "2001-08-02 00:00:00"
MINIMUM_AUC = 0.55
VERSION = "v1"

CHAMPION, CHALLENGER = "p_champion", "p_challenger"
OUTCOME, PREDICTED = "actual_is_delayed", "predicted_class"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[["Data"], DataFrame]) -> Callable[["Data"], DataFrame]:
    QUERIES[function.__name__] = lambda spark, sf_dir: function(Data(spark, sf_dir))
    return function


class Data:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def path(self, name: str) -> str:
        return fresh_path(self.spark, name)

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        return driver_tables.RawTables(self.spark, self.sf_dir)

    @cached_property
    def stg(self) -> dict[str, DataFrame]:
        return build.StagedTables(self.raw)

    @property
    def orders(self) -> DataFrame:
        return self.stg["stg_orders"]

    @property
    def items(self) -> DataFrame:
        return self.stg["stg_order_items"]

    @cached_property
    def delays(self) -> DataFrame:
        return marts.with_delays(self.orders)

    @cached_property
    def core(self) -> DataFrame:
        return build.order_core(self.stg)

    @cached_property
    def enriched(self) -> DataFrame:
        return build.intermediate(self.stg)["int_orders_enriched"]

    @cached_property
    def fact(self) -> DataFrame:
        return marts.fact_orders(
            marts.with_review_and_category(self.core, self.stg["stg_order_reviews"], self.stg["stg_products"])
        )

    @cached_property
    def dims(self) -> dict[str, DataFrame]:
        return {
            "customers": marts.dim_customers(self.stg["stg_customers"]),
            "sellers": marts.dim_sellers(self.stg["stg_sellers"]),
            "products": marts.dim_products(self.stg["stg_products"]),
        }

    @cached_property
    def features(self) -> DataFrame:
        return features.order_features(
            self.core, self.dims["customers"], self.dims["sellers"], self.dims["products"]
        )

    @cached_property
    def stored_features(self) -> DataFrame:
        """The exported feature table; several steps read it."""
        return sinks.overwrite(self.features, self.path("features"))

    def labelled_split(self, table: DataFrame) -> DataFrame:
        return splits.with_split(
            splits.labelled(table, contract.LABEL), "order_purchase_timestamp", VALIDATION_START, TEST_START
        )

    def drift_sides(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Training slice, all current rows, and these with shifted payments and categories."""
        table = self.stored_features
        at = F.col("order_purchase_timestamp")
        train = splits.labelled(table, contract.LABEL).where(at < splits.cut(VALIDATION_START))
        shifted = table.withColumns(
            {
                "total_payment_value": F.col("total_payment_value") * F.lit(1.5),
                "product_category": F.when(F.col("order_id") % 4 == 0, F.lit("special")).otherwise(
                    F.col("product_category")
                ),
            }
        )
        return train, table, shifted

    @cached_property
    def scores(self) -> DataFrame:
        scores = driver_tables.synthetic_scores(self.spark, self.sf_dir)
        return scores.withColumn(PREDICTED, fn.predicted_class(F.col(CHAMPION)))

    @cached_property
    def scored(self) -> DataFrame:
        """The scores in the column names of the monitoring jobs."""
        return self.scores.select(
            "order_id", F.col(CHAMPION).alias("predicted_probability"), PREDICTED, "order_date", OUTCOME
        )

    @cached_property
    def predictions(self) -> DataFrame:
        return self.scores.select(
            "order_id",
            F.col(CHAMPION).alias("predicted_probability"),
            PREDICTED,
            F.lit(VERSION).alias("model_version"),
            F.lit(RUN_STAMP).cast("timestamp_ntz").alias("prediction_timestamp"),
        )

    @cached_property
    def bridge(self) -> DataFrame:
        return features.fct_predictions(self.predictions, self.fact)

    @cached_property
    def score_split(self) -> DataFrame:
        return splits.with_split(self.scores, "order_date", VALIDATION_START, TEST_START)

    @property
    def split_scores(self) -> DataFrame:
        """The split scores in the column names of the modeling jobs."""
        return self.score_split.withColumnRenamed(CHAMPION, "predicted_probability")

    @cached_property
    def monthly(self) -> DataFrame:
        return monitoring.monthly_metrics(self.scored, BASELINE_AUC)

    @cached_property
    def registry(self) -> DataFrame:
        """Registry row of the champion: sizes and held-out quality from the whole score table."""
        held_out = self.score_split.where(F.col("split") != splits.TRAIN)
        quality_rows = classification.quality_report(held_out, CHAMPION, OUTCOME, PREDICTED, ["split"])
        last_train = self.score_split.where(F.col("split") == splits.TRAIN).agg(F.max("order_date").alias("day"))
        row = retraining.registry_row(
            VERSION, F.lit(None).cast("date"), VALIDATION_START, TEST_START,
            splits.split_sizes(self.score_split), quality_rows,
        )
        return row.drop("trained_on").crossJoin(last_train.withColumnRenamed("day", "trained_on"))

    @cached_property
    def numeric_drift(self) -> DataFrame:
        train, _, shifted = self.drift_sides()
        return drift.numeric_drift(train, shifted, contract.NUMERIC_FEATURES)

    @cached_property
    def comparison(self) -> DataFrame:
        test = self.score_split.where(F.col("split") == splits.TEST)
        return retraining.compare_models(test)

    def model(self) -> tuple[modeling.DelayModel, DataFrame]:
        """A model fitted on the stored training slice, and the labelled split it came from."""
        split = self.labelled_split(self.stored_features)
        splits.require_splits(split)
        train = sinks.overwrite(split.where(F.col("split") == splits.TRAIN), self.path("train"))
        return modeling.fit(train, VERSION), split

    def rule_model(self) -> modeling.LinearModel:
        """A linear model whose weights follow from counts, so that another engine can work them out as well: how much
        more often a late order is above the median, and how much later a category is than all. Fits are tested apart."""
        split = self.labelled_split(self.stored_features)
        train = sinks.overwrite(split.where(F.col("split") == splits.TRAIN), self.path("train"))
        medians = {r["feature"]: r["median"] for r in modeling.numeric_statistics(train).select("feature", "median").collect()}
        vocabulary = sinks.overwrite(modeling.category_vocabulary(train), self.path("vocabulary"))
        labels = modeling.slot_labels(vocabulary)
        late = F.col("is_delayed") == 1
        above = [F.col(c) > F.lit(medians[c]) for c in contract.NUMERIC_FEATURES]
        counts = train.agg(
            F.count_if(late).alias("late"), F.count_if(~late).alias("other"),
            *[F.count_if(late & a).alias(f"late{i}") for i, a in enumerate(above)], *[F.count_if(~late & a).alias(f"other{i}") for i, a in enumerate(above)],
        )
        shares = [F.col(f"late{i}") / F.col("late") - F.col(f"other{i}") / F.col("other") for i in range(len(above))]
        odds = F.log(F.col("late") / F.col("other"))
        row = counts.select(F.transform(F.array(*shares), lambda v: F.round(v, 6)).alias("weights"), F.round(odds, 6).alias("intercept"),
                            "late", (F.col("late") + F.col("other")).alias("n")).first()
        slots = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_c_{c}").cast("int").alias("slot")) for c in contract.CATEGORICAL_FEATURES])
        encoded = modeling.encode(train, {c: (medians[c], 0.0, 1.0) for c in medians}, labels, vocabulary)
        rates = encoded.select("is_delayed", F.inline(slots)).groupBy("feature", "slot").agg((F.count_if(late) / F.count("*")).alias("rate"))
        overall = F.lit(row["late"]) / F.lit(row["n"])
        found = {(r["feature"], r["slot"]): r["weight"] for r in rates.select("feature", "slot", F.round(F.col("rate") - overall, 6).alias("weight")).collect()}
        weights = [found[c, slot] for c in contract.CATEGORICAL_FEATURES for slot in range(len(labels[c]))]
        return modeling.LinearModel(VERSION, {c: (medians[c], 0.0, 1.0) for c in medians}, labels, vocabulary, row["n"], [*row["weights"], *weights], row["intercept"])

    def write_csv(self, df: DataFrame, path: str) -> str:
        df.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
        return path


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ---- scans and sinks ---------------------------------------------------------------------------


@query
def scan_csv(d: Data) -> DataFrame:
    """Review text with quotes, commas and line breaks through CSV and back."""
    text = F.concat(F.lit('said "'), "review_comment_message", F.lit('", twice\nand left'))
    raw = d.raw["order_reviews"].withColumn("review_comment_message", text)
    path = d.write_csv(raw, d.path("reviews-csv"))
    scanned = catalog.scan_csv(d.spark, path, catalog.RAW_SCHEMAS["order_reviews"], multi_line=True)
    return staging.stg_order_reviews(scanned).select(
        F.col("review_id").cast("bigint").alias("review_id"),
        F.col("order_id").cast("bigint").alias("order_id"),
        "review_score", "review_comment_title", "review_comment_message", "review_created_at",
        "review_answered_at",
    )


@query
def scan_bound_source(d: Data) -> DataFrame:
    root = d.path("raw")
    d.write_csv(d.raw["sellers"], f"{root}/sellers.csv")
    sellers = catalog.bind_sources(root)["sellers"].scan(d.spark)
    return staging.stg_sellers(sellers).withColumn("seller_id", F.col("seller_id").cast("bigint"))


@query
def load_sources_audit(d: Data) -> DataFrame:
    """Four of the eight sources are present; the audit lists what was loaded."""
    root = d.path("raw")
    for name in ("customers", "sellers", "products", "geolocation"):
        d.write_csv(d.raw[name], f"{root}/{name}.csv")
    return catalog.row_audit(catalog.load_sources(d.spark, catalog.bind_sources(root)))


@query
def scan_parquet(d: Data) -> DataFrame:
    """Filter and columns reach the scan."""
    lines = catalog.scan_parquet(d.spark, f"{d.sf_dir}/lineitem.parquet")
    recent = lines.where(F.col("l_shipdate") >= splits.cut(TEST_START))
    return recent.groupBy("l_returnflag").agg(
        F.count("*").alias("n_rows"), F.max("l_shipdate").alias("last_shipdate")
    )


@query
def sink_overwrite(d: Data) -> DataFrame:
    path = d.path("daily")
    sinks.overwrite(metrics.met_daily_revenue(d.core), path)
    return sinks.overwrite(metrics.met_daily_gmv(d.core), path)


@query
def export_features(d: Data) -> DataFrame:
    return d.stored_features


@query
def sink_predictions(d: Data) -> DataFrame:
    """Two versions written, one of them again: only its partition is replaced."""
    path = d.path("predictions")
    stamp = F.to_timestamp(F.lit(RUN_STAMP))
    first = d.predictions.withColumn("prediction_timestamp", stamp).withColumn(
        "order_id", F.col("order_id").cast("string")
    )
    second = first.withColumn("model_version", F.lit("v2"))
    sinks.write_predictions(first, path)
    sinks.write_predictions(second, path)
    sinks.write_predictions(second.withColumn("predicted_probability", F.lit(1.0) - F.col("predicted_probability")), path)
    return sinks.read_predictions(d.spark, path).select(
        F.col("order_id").cast("bigint").alias("order_id"), "predicted_probability", "predicted_class",
        "model_version", "run_date",
    )


@query
def train_snapshot(d: Data) -> DataFrame:
    split = d.labelled_split(d.features)
    return sinks.overwrite(split.where(F.col("split") == splits.TRAIN).drop("split"), d.path("train"))


@query
def latest_report(d: Data) -> DataFrame:
    """Reports of two runs, of the last month and of all months before it, appended in reverse order."""
    path = d.path("reports")
    months = monitoring.monthly_confusion(d.scored).withColumn(
        "run_at", F.to_date(F.concat("period", F.lit("-01")))
    )
    last = months.agg(F.max("period").alias("last_period"))
    tagged = months.crossJoin(F.broadcast(last))
    report = F.to_json(F.struct("period", "tp", "fp", "fn", "tn")).alias("report_json")
    sinks.append_report(tagged.where("period = last_period").select("run_at", report), path)
    sinks.append_report(tagged.where("period < last_period").select("run_at", report), path)
    return sinks.latest_report(d.spark.read.parquet(path))


@query
def materialize_layer(d: Data) -> DataFrame:
    """Metric from a stored order row."""
    stored = sinks.materialize(d.core, d.path("order_core"))
    return sinks.materialize(metrics.met_daily_delay_rate(stored), None)


@query
def monitoring_report(d: Data) -> DataFrame:
    """The report document, read back: overall quality, alert months, drift status."""
    train, _, shifted = d.drift_sides()
    report = monitoring.monitoring_report(
        d.scored, drift.drift_report(train, shifted), F.lit(RUN_STAMP).cast("timestamp_ntz"), BASELINE_AUC
    )
    schema = """overall struct<n_rows: bigint, roc_auc: double, precision_at_k: double,
        cost_analysis: struct<estimated_total_cost: double>>,
        monthly_windows array<struct<period: string, roc_auc: double, roc_auc_alert: boolean>>,
        any_monthly_roc_alert boolean, drift struct<overall_status: string,
        numeric: array<struct<feature: string, psi: double, status: string>>,
        categorical: array<struct<feature: string, top_shifts: array<struct<category: string>>>>>"""
    doc = F.from_json("report_json", schema)
    return report.select(
        "run_at",
        doc["overall"]["n_rows"].alias("n_rows"),
        doc["overall"]["roc_auc"].alias("roc_auc"),
        doc["overall"]["precision_at_k"].alias("precision_at_k"),
        doc["overall"]["cost_analysis"]["estimated_total_cost"].alias("estimated_total_cost"),
        F.size(doc["monthly_windows"]).cast("bigint").alias("n_months"),
        F.size(F.filter(doc["monthly_windows"], lambda w: w["roc_auc_alert"])).cast("bigint").alias("n_alerts"),
        F.size(F.filter(doc["monthly_windows"], lambda w: w["roc_auc"].isNull())).cast("bigint").alias("n_undefined"),
        doc["any_monthly_roc_alert"].cast("int").alias("any_alert"),
        doc["drift"]["overall_status"].alias("drift_status"),
        F.size(F.filter(doc["drift"]["numeric"], lambda n: n["status"] == "unknown")).cast("bigint").alias("n_unknown"),
        F.array_join(F.transform(doc["drift"]["categorical"], lambda c: c["top_shifts"][0]["category"]), ",").alias(
            "first_shifts"
        ),
    )


# ---- staging -----------------------------------------------------------------------------------


def staging_query(name: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: Data(spark, sf_dir).stg[name]


for _name in (
    "stg_orders", "stg_order_items", "stg_order_payments", "stg_order_reviews", "stg_customers", "stg_sellers",
    "stg_products",
):
    staging_query(_name)


@query
def stg_geolocation(d: Data) -> DataFrame:
    return rounded(d.stg["stg_geolocation"], "latitude", "longitude")


@query
def cast_timestamps(d: Data) -> DataFrame:
    """Times as text, absent ones as empty text."""
    times = ["order_purchase_timestamp", "order_delivered_carrier_date", "order_delivered_customer_date"]
    text = d.raw["orders"].withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in times})
    return text.select("order_id", *[fn.as_timestamp(F.col(c)).alias(c) for c in times])


# ---- scalar operators ----------------------------------------------------------------------------


@query
def delivery_day_metrics(d: Data) -> DataFrame:
    return d.delays.select("order_id", "delivery_days", "estimated_delivery_days", "delay_days")


@query
def late_flag(d: Data) -> DataFrame:
    return d.delays.select("order_id", "is_delayed")


@query
def calendar_features(d: Data) -> DataFrame:
    return d.orders.select("order_id", *features.calendar_columns("order_purchased_at"))


@query
def product_volume(d: Data) -> DataFrame:
    sides = [F.col(c) for c in ("length_cm", "height_cm", "width_cm")]
    return d.stg["stg_products"].select("product_id", fn.volume(*sides).alias("product_volume_cm3"))


@query
def same_state_flag(d: Data) -> DataFrame:
    """Every line's seller against the buyer of its order; unknown sides give null."""
    lines = d.items.select("order_id", "item_sequence", "seller_id")
    buyers = d.orders.join(d.stg["stg_customers"], "customer_id", "left").select("order_id", "customer_state")
    shops = d.stg["stg_sellers"].select("seller_id", F.nullif("seller_state", F.lit("AS")).alias("seller_state"))
    flag = fn.flag(F.col("customer_state") == F.col("seller_state"))
    return (
        lines.join(buyers, "order_id", "left")
        .join(shops, "seller_id", "left")
        .select("order_id", "item_sequence", flag.alias("customer_seller_same_state"))
    )


@query
def safe_divide(d: Data) -> DataFrame:
    return marts.item_rollup(d.items).select(
        "order_id",
        fn.safe_divide(F.col("total_freight_value"), F.col("item_count") - 1).alias("freight_per_extra_item"),
    )


@query
def cents_to_currency(d: Data) -> DataFrame:
    cents = F.rint(F.col("price") * 100).cast("bigint")
    return d.items.select("order_id", "item_sequence", fn.cents_to_currency(cents).alias("price"))


@query
def surrogate_key(d: Data) -> DataFrame:
    state = F.nullif("customer_state", F.lit("AS"))
    return d.stg["stg_customers"].select(
        "customer_id", fn.surrogate_key(F.col("customer_unique_id"), state).alias("person_state_key")
    )


@query
def coerce_features(d: Data) -> DataFrame:
    """Order columns as text, some of it no number, and absent categories."""
    weight = F.coalesce(F.col("product_weight_g").cast("string"), F.lit("n/a"))
    text = d.stg["stg_products"].withColumnRenamed("weight_g", "product_weight_g").select(
        "product_id",
        weight.alias("product_weight_g"),
        F.nullif("product_category_name", F.lit("")).alias("product_category"),
    )
    return features.coerce_features(text)


@query
def classify_threshold(d: Data) -> DataFrame:
    return d.scores.select("order_id", CHAMPION, fn.predicted_class(F.col(CHAMPION)).alias(PREDICTED))


@query
def psi_status(d: Data) -> DataFrame:
    """The bands applied to every day's delay rate, rates of 1 standing in for undefined ones."""
    rate = F.nullif("delay_rate", F.lit(1.0))
    return metrics.met_daily_delay_rate(d.core).select(
        "order_date", fn.band(rate, contract.PSI_WARNING, contract.PSI_ALERT).alias("status")
    )


@query
def validate_columns(d: Data) -> DataFrame:
    """Rows of the complete frame, and what a frame without two of its columns lacks."""
    complete = features.validate_columns(d.features)
    lacking = features.missing_columns(d.features.drop("order_hour", "seller_state"))
    return complete.agg(F.count("*").alias("n_rows")).withColumn("missing", F.lit(",".join(lacking)))


@query
def feature_matrix(d: Data) -> DataFrame:
    return features.feature_matrix(d.features)


@query
def calendar_months_between(d: Data) -> DataFrame:
    start, end = F.col("order_purchased_at"), F.col("order_estimated_delivery_at")
    return d.orders.select("order_id", fn.calendar_months(start, end).alias("months"))


# ---- filters -------------------------------------------------------------------------------------


@query
def valid_orders(d: Data) -> DataFrame:
    return metrics.valid_orders(d.core).select("order_id", "order_date", "order_status", "item_count", "total_payment_value")


@query
def delay_eligible(d: Data) -> DataFrame:
    return metrics.delay_eligible(d.core).select("order_id", "order_date", "is_delayed")


@query
def scored_frame(d: Data) -> DataFrame:
    return monitoring.scored_frame(d.bridge)


@query
def temporal_split(d: Data) -> DataFrame:
    table = d.core.select("order_id", F.col("order_purchased_at").alias("order_purchase_timestamp"), "is_delayed")
    return d.labelled_split(table).select("order_id", "split")


@query
def extended_split(d: Data) -> DataFrame:
    table = splits.labelled(d.core.select("order_id", "order_purchased_at", "is_delayed"), "is_delayed")
    split = splits.extended_split(table, "order_purchased_at", EXTENDED_END, TEST_START)
    return splits.split_sizes(split)


# ---- intermediate results, dimensions, facts -------------------------------------------------------


@query
def payments_aggregated(d: Data) -> DataFrame:
    return marts.payments_aggregated(d.stg["stg_order_payments"])


@query
def order_status_normalized(d: Data) -> DataFrame:
    return marts.order_status_normalized(d.orders)


@query
def latest_review(d: Data) -> DataFrame:
    return marts.latest_review(d.stg["stg_order_reviews"])


@query
def int_orders_enriched(d: Data) -> DataFrame:
    return d.enriched


@query
def item_rollup(d: Data) -> DataFrame:
    return marts.item_rollup(d.items)


@query
def primary_line(d: Data) -> DataFrame:
    return marts.primary_line(d.items, d.stg["stg_products"])


@query
def dim_customers(d: Data) -> DataFrame:
    return d.dims["customers"]


@query
def dim_sellers(d: Data) -> DataFrame:
    return d.dims["sellers"]


@query
def dim_products(d: Data) -> DataFrame:
    return d.dims["products"]


@query
def fact_order_items(d: Data) -> DataFrame:
    return marts.fact_order_items(d.items, d.dims["products"], d.dims["sellers"])


@query
def fact_orders(d: Data) -> DataFrame:
    return d.fact


# ---- metrics and features --------------------------------------------------------------------------


@query
def met_daily_gmv(d: Data) -> DataFrame:
    return metrics.met_daily_gmv(d.core)


@query
def met_daily_revenue(d: Data) -> DataFrame:
    return metrics.met_daily_revenue(d.core)


@query
def met_daily_delay_rate(d: Data) -> DataFrame:
    return metrics.met_daily_delay_rate(d.core)


@query
def seller_history(d: Data) -> DataFrame:
    rows = d.core.select("order_id", "seller_id", "order_purchased_at", "delivery_days")
    return features.seller_history(rows).select("order_id", "seller_id", "seller_avg_delivery_days_historical")


@query
def order_features(d: Data) -> DataFrame:
    return d.features


@query
def fct_predictions(d: Data) -> DataFrame:
    return d.bridge


@query
def latest_predictions(d: Data) -> DataFrame:
    return features.latest_predictions(d.bridge, 10)


# ---- quality ---------------------------------------------------------------------------------------


@query
def assert_unique(d: Data) -> DataFrame:
    return checks.unique(d.stg["stg_order_payments"], ["order_id"])


@query
def assert_unique_combination(d: Data) -> DataFrame:
    return checks.unique(d.items, ["product_id", "seller_id"])


@query
def assert_not_null(d: Data) -> DataFrame:
    return checks.not_null(d.enriched, marts.ENRICHED_COLUMNS)


@query
def assert_accepted_values(d: Data) -> DataFrame:
    known = [s for s in contract.ORDER_STATUSES if s != "unavailable"]
    return checks.accepted_values(d.orders, "order_status", known)


@query
def assert_relationships(d: Data) -> DataFrame:
    """Lines against the products that weigh something known."""
    known = d.stg["stg_products"].where(F.col("weight_g").isNotNull())
    return checks.relationships(d.items, "product_id", known, "product_id")


@query
def assert_equal_rowcount(d: Data) -> DataFrame:
    return checks.equal_rowcount(d.scores, d.core)


@query
def assert_no_future_orders(d: Data) -> DataFrame:
    late = checks.later_than(d.orders, "order_purchased_at", splits.cut(AS_OF))
    return late.select("order_id", "order_purchased_at")


@query
def assert_unit_interval(d: Data) -> DataFrame:
    """Probabilities scaled beyond 1, some of them null."""
    scaled = F.nullif(F.col(CHAMPION) * F.lit(1.25), F.lit(0.0)).alias("predicted_probability")
    return checks.outside_unit_interval(
        d.scores.select("order_id", scaled), "predicted_probability", null_is_bad=True
    )


@query
def metric_reconcile_gmv(d: Data) -> DataFrame:
    """A metric with one unit too much per day against the fact."""
    wrong = metrics.met_daily_gmv(d.core).withColumn("gmv", F.col("gmv") + F.lit(1.0))
    return quality.gmv_mismatch(wrong, d.core)


@query
def metric_reconcile_revenue(d: Data) -> DataFrame:
    """The GMV of all valid orders passed off as revenue."""
    wrong = metrics.met_daily_gmv(d.core).withColumnRenamed("gmv", "revenue")
    return quality.revenue_mismatch(wrong, d.core)


@query
def leakage_check(d: Data) -> DataFrame:
    """Features with labels removed, labels invented and history on first orders, by rules on the rows."""
    bad = d.features.withColumns(
        {
            "is_delayed": F.when(F.hour("order_purchase_timestamp") == 3, F.lit(None))
            .when(F.hour("order_purchase_timestamp") == 5, F.lit(1))
            .otherwise(F.col("is_delayed")),
            "seller_avg_delivery_days_historical": F.coalesce("seller_avg_delivery_days_historical", F.lit(0.0)),
        }
    )
    return features.leakage_check(bad, d.delays)


@query
def quality_suite(d: Data) -> DataFrame:
    tables = build.build(d.raw.with_stored_lines(), d.path("marts"), splits.cut(AS_OF))
    tables["fct_predictions"] = sinks.overwrite(
        features.fct_predictions(d.predictions, tables["fact_orders"]), d.path("fct_predictions")
    )
    summary = quality.quality_suite(tables, splits.cut(AS_OF)).summary()
    return summary.withColumn("passed", F.col("passed").cast("int"))


# ---- model quality -----------------------------------------------------------------------------------


@query
def class_balance(d: Data) -> DataFrame:
    table = d.core.select(F.col("order_purchased_at").alias("order_purchase_timestamp"), "is_delayed")
    return splits.class_balance(d.labelled_split(table), "is_delayed")


@query
def confusion_matrix(d: Data) -> DataFrame:
    return classification.confusion_matrix(d.scores, OUTCOME, PREDICTED)


@query
def classification_metrics(d: Data) -> DataFrame:
    return classification.classification_metrics(d.score_split, OUTCOME, PREDICTED, ["split"])


@query
def roc_auc(d: Data) -> DataFrame:
    return classification.roc_auc(d.score_split, CHAMPION, OUTCOME, ["split"])


@query
def precision_at_k(d: Data) -> DataFrame:
    return classification.precision_at_top(d.scores, CHAMPION, OUTCOME, "order_id")


@query
def cost_analysis(d: Data) -> DataFrame:
    return classification.cost_analysis(d.scores, OUTCOME, PREDICTED)


@query
def auc_gate(d: Data) -> DataFrame:
    test = d.score_split.where(F.col("split") == splits.TEST)
    gate = modeling.auc_gate(classification.roc_auc(test, CHAMPION, OUTCOME), MINIMUM_AUC)
    return gate.withColumn("passed", F.col("passed").cast("int"))


@query
def monthly_confusion(d: Data) -> DataFrame:
    return monitoring.monthly_confusion(d.scored)


@query
def monthly_metrics(d: Data) -> DataFrame:
    return d.monthly.withColumn("roc_auc_alert", F.col("roc_auc_alert").cast("int"))


@query
def overall_metrics(d: Data) -> DataFrame:
    overall = monitoring.overall_metrics(d.scored, BASELINE_AUC)
    alert = "roc_auc_below_baseline_alert"
    return overall.withColumn(alert, F.col(alert).cast("int"))


# ---- drift -------------------------------------------------------------------------------------------


def ranked_counts(d: Data) -> DataFrame:
    train, test, _ = d.drift_sides()
    return drift.with_ranks(drift.numeric_counts(train, test, contract.NUMERIC_FEATURES))


@query
def quantile_edges(d: Data) -> DataFrame:
    edges = drift.bin_edges(ranked_counts(d))
    return edges.select("feature", F.posexplode("edges").alias("position", "edge"))


@query
def histogram_counts(d: Data) -> DataFrame:
    ranked = ranked_counts(d)
    return drift.histogram(ranked, drift.bin_edges(ranked)).drop("n_edges")


@query
def psi_numeric(d: Data) -> DataFrame:
    train, test, _ = d.drift_sides()
    return rounded(drift.numeric_drift(train, test, contract.NUMERIC_FEATURES).select("feature", "psi"), "psi")


@query
def numeric_drift(d: Data) -> DataFrame:
    return rounded(d.numeric_drift, "psi")


@query
def categorical_drift(d: Data) -> DataFrame:
    train, _, shifted = d.drift_sides()
    return drift.categorical_drift(train, shifted, contract.CATEGORICAL_FEATURES)


@query
def categorical_drift_top(d: Data) -> DataFrame:
    train, _, shifted = d.drift_sides()
    return drift.top_shifts(drift.category_shares(train, shifted, contract.CATEGORICAL_FEATURES))


@query
def drift_overall(d: Data) -> DataFrame:
    """Overall status of the unshifted and of the shifted test slice."""
    train, test, shifted = d.drift_sides()
    return (
        drift.drift_report(train, test)
        .overall.withColumn("side", F.lit("test"))
        .unionByName(drift.drift_report(train, shifted).overall.withColumn("side", F.lit("shifted")))
    )


# ---- model -------------------------------------------------------------------------------------------


@query
def prepare_numeric(d: Data) -> DataFrame:
    train = d.drift_sides()[0]
    return rounded(modeling.numeric_statistics(train), "median", "mean", "scale")


@query
def category_vocabulary(d: Data) -> DataFrame:
    return modeling.category_vocabulary(d.drift_sides()[0])


@query
def train_logistic(d: Data) -> DataFrame:
    """Every input of the fitted model, and that the penalised loss has no slope there."""
    model, split = d.model()
    checked = modeling.optimality(model, split.where(F.col("split") == splits.TRAIN))
    return checked.select("feature", F.col("optimal").cast("int").alias("optimal"))


@query
def top_coefficients(d: Data) -> DataFrame:
    return modeling.top_coefficients(d.rule_model(), 25)


@query
def score_orders(d: Data) -> DataFrame:
    """Scores from a stored table of coefficients."""
    stored = modeling.save(d.rule_model(), d.path("model"))
    loaded = modeling.load_linear(d.spark, *stored.rsplit("/", 1))
    return rounded(modeling.score(loaded, d.stored_features, F.lit(RUN_STAMP).cast("timestamp_ntz")), "predicted_probability", digits=9)


@query
def score_dry_run(d: Data) -> DataFrame:
    model, _ = d.model()
    return modeling.score_dry_run(model, d.stored_features)


@query
def evaluate_split(d: Data) -> DataFrame:
    """Quality of given scores on the held-out splits; fitted models are evaluated in the unit tests."""
    return modeling.evaluate(d.split_scores.where(F.col("split") != splits.TRAIN), ["split"])


@query
def evaluation_summary(d: Data) -> DataFrame:
    return modeling.evaluation_summary(d.split_scores, d.score_split)


# ---- retraining --------------------------------------------------------------------------------------


@query
def baseline_lookup(d: Data) -> DataFrame:
    return monitoring.baseline_lookup(d.registry)


@query
def longest_alert_run(d: Data) -> DataFrame:
    return retraining.longest_alert_run(d.monthly)


def triggers(d: Data) -> tuple[DataFrame, DataFrame, DataFrame]:
    last_day = d.orders.agg(F.max("order_purchased_at").alias("last_day"))
    registry = d.registry.crossJoin(last_day)
    return (
        retraining.trigger_performance(d.monthly),
        retraining.trigger_drift(d.numeric_drift),
        retraining.trigger_calendar(registry, F.col("last_day")),
    )


def with_number(df: DataFrame) -> DataFrame:
    return df.withColumn("fired", F.col("fired").cast("int"))


@query
def trigger_performance(d: Data) -> DataFrame:
    return with_number(retraining.trigger_performance(d.monthly))


@query
def trigger_drift(d: Data) -> DataFrame:
    return with_number(retraining.trigger_drift(d.numeric_drift))


@query
def trigger_calendar(d: Data) -> DataFrame:
    last_day = d.orders.agg(F.max("order_purchased_at").alias("last_day"))
    return with_number(retraining.trigger_calendar(d.registry.crossJoin(last_day), F.col("last_day")))


@query
def retrain_decision(d: Data) -> DataFrame:
    return retraining.retrain_decision(*triggers(d))


@query
def compare_models(d: Data) -> DataFrame:
    return d.comparison.withColumn("promoted", F.col("promoted").cast("int"))


@query
def promote_registry(d: Data) -> DataFrame:
    split = splits.extended_split(d.scores, "order_date", EXTENDED_END, TEST_START)
    validation = split.where(F.col("split") == splits.VALIDATION)
    challenger = validation.withColumn("challenger_class", fn.predicted_class(F.col(CHALLENGER)))
    quality_row = classification.quality_report(challenger, CHALLENGER, OUTCOME, "challenger_class")
    return retraining.promote_registry(
        d.registry, d.comparison, splits.split_sizes(split), quality_row, F.lit(AS_OF).cast("date"), EXTENDED_END
    )
