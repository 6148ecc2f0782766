"""Declared raw schemas and scans. Nothing is inferred: inference reads the data twice and guesses types."""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Raw columns. Times and numbers arrive as text and are cast by the staging plans, so one
# bad field does not lose the row.
RAW_SCHEMAS = {
    "orders": """order_id string, customer_id string, order_status string, order_purchase_timestamp string,
        order_approved_at string, order_delivered_carrier_date string, order_delivered_customer_date string,
        order_estimated_delivery_date string""",
    "order_items": """order_id string, order_item_id int, product_id string, seller_id string,
        shipping_limit_date string, price double, freight_value double""",
    "order_payments": """order_id string, payment_sequential int, payment_type string,
        payment_installments int, payment_value double""",
    "order_reviews": """review_id string, order_id string, review_score int, review_comment_title string,
        review_comment_message string, review_creation_date string, review_answer_timestamp string""",
    "customers": """customer_id string, customer_unique_id string, customer_zip_code_prefix string,
        customer_city string, customer_state string""",
    "sellers": "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string",
    "products": """product_id string, product_category_name string, product_name_lenght int,
        product_description_lenght int, product_photos_qty int, product_weight_g double,
        product_length_cm double, product_height_cm double, product_width_cm double""",
    "geolocation": """geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double,
        geolocation_city string, geolocation_state string""",
}
# Free text that may hold line breaks. Finding its records takes a second look at the lines, so only where needed.
MULTI_LINE = {"order_reviews"}
ROOT_VARIABLE = "STALLWISE_DATA_ROOT"


@dataclass(frozen=True)
class Source:
    """A named input bound to a location and a format."""

    name: str
    location: str
    format: str
    schema: str | StructType | None = None
    multi_line: bool = False

    def scan(self, spark: SparkSession) -> DataFrame:
        if self.format == "csv":
            return scan_csv(spark, self.location, self.schema, self.multi_line)
        if self.format == "parquet":
            return scan_parquet(spark, self.location, self.schema)
        raise ValueError(f"source {self.name}: unsupported format {self.format}")


CSV_OPTIONS = {"quote": '"', "escape": '"'}


def scan_csv(spark: SparkSession, path: str, schema: str | StructType, multi_line: bool = False) -> DataFrame:
    """Header row, doubled quotes; ``multi_line`` for quoted text that contains line breaks."""
    if multi_line:
        return scan_records(spark, path, schema)
    return spark.read.schema(schema).option("header", True).options(**CSV_OPTIONS).csv(path)


def csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block, line, at, cr, odd: the lines of every byte range in their order, and whether they end
    with a carriage return and whether their quotes are odd in number.

    A byte range of a file is read by one task from its beginning, so numbers given there follow the order of its lines.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))
    numbered = lines.withColumn("at", F.monotonically_increasing_id()).withColumn("cr", F.endswith("line", F.lit("\r")))
    return numbered.withColumn("odd", (F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))) % 2)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """file, record, text: the records of CSV files whose quoted fields may hold line breaks, header records included.

    A line begins a record if the quotes before it in its file are even in number. Byte ranges are read by tasks of their own:
    quotes are counted per range, a running sum of their parities over the ranges of a file tells with which parity a
    range begins, and a range has counted its record starts for either parity, so records are numbered through the file.
    Only records of several lines are brought together. Fields that hold a quote have to be quoted themselves, with
    inner quotes doubled; a quoted field that never ends takes the rest of its file into its record.
    """
    lines = csv_lines(spark, path)
    upto = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)

    def counted(rows: DataFrame) -> DataFrame:
        return rows.withColumn("before", F.coalesce(F.sum("odd").over(upto), F.lit(0)) % 2)

    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # the text itself stays out of this pass
    ranges = counted(lines.select("file", "block", "at", "cr", "odd")).groupBy("file", "block").agg(
        F.sum("odd").alias("odd"), F.min_by("cr", "at").alias("cr"), F.count_if(F.col("before") == 0).alias("starts_even"), F.count_if(F.col("before") == 1).alias("starts_odd"))
    ranges = ranges.withColumn("inside", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    starts = F.when(F.col("inside") == 0, F.col("starts_even")).otherwise(F.col("starts_odd"))
    ends = F.first("cr").over(Window.partitionBy("file").orderBy("block"))
    ranges = ranges.withColumn("starts", starts).select("file", "block", "inside", ends.alias("crlf"), F.coalesce(F.sum("starts").over(earlier), F.lit(0)).alias("first"))
    placed = counted(lines).join(ranges, ["file", "block"])
    is_start = (F.col("before") + F.col("inside")) % 2 == 0
    through = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    numbered = placed.withColumn("start", is_start).withColumn("record", F.col("first") + F.sum(F.col("start").cast("bigint")).over(through) - 1)
    alone = F.col("start") & (F.col("odd") == 0)
    parts = numbered.where(~alone).groupBy("file", "record").agg(F.first("crlf").alias("crlf"), F.sort_array(F.collect_list(F.struct("block", "at", "line"))).alias("parts"))
    several = parts.select("file", "record", "crlf", F.array_join(F.transform("parts", lambda p: p["line"]), "\n").alias("text"))
    every = numbered.where(alone).select("file", "record", "crlf", F.col("line").alias("text")).unionByName(several)
    # as the plain reader does: where the first line of a file ends with CR LF, line breaks in its fields become LF
    text = F.when(F.col("crlf"), F.regexp_replace(F.replace("text", F.lit("\r\n"), F.lit("\n")), r"\r$", "")).otherwise(F.col("text"))
    return every.select("file", "record", text.alias("text"))


def scan_records(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """CSV with line breaks in quoted fields, each file read by as many tasks as it has splits."""
    rows = csv_records(spark, path).where("record > 0 and text <> ''").select("text")
    ddl = schema.simpleString() if isinstance(schema, StructType) else schema
    return rows.select(F.from_csv("text", ddl, CSV_OPTIONS).alias("row")).select("row.*")


def scan_parquet(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def bind_sources(root: str | None = None, suffix: str = ".csv", format: str = "csv") -> dict[str, Source]:
    """The eight raw sources under one root; the root defaults to an environment variable."""
    base = (root or os.environ.get(ROOT_VARIABLE, "data/raw")).rstrip("/")
    return {
        name: Source(name, f"{base}/{name}{suffix}", format, schema, name in MULTI_LINE)
        for name, schema in RAW_SCHEMAS.items()
    }


def exists(spark: SparkSession, location: str) -> bool:
    """Asks the file system that owns the path, so it works for any URI scheme."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def load_sources(spark: SparkSession, sources: dict[str, Source]) -> dict[str, DataFrame]:
    """Scans of the sources that are present; absent ones are left out."""
    return {name: s.scan(spark) for name, s in sources.items() if exists(spark, s.location)}


def row_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table in one job; only a literal per row is shuffled, after map-side counting."""
    tagged = [df.select(F.lit(name).alias("table_name")) for name, df in tables.items()]
    counted = reduce(DataFrame.unionByName, tagged).groupBy("table_name").agg(F.count("*").alias("n_rows"))
    names = tables_frame(next(iter(tables.values())).sparkSession, list(tables))
    return names.join(counted, "table_name", "left").select(
        "table_name", F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows")
    )


def tables_frame(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("table_name"))
