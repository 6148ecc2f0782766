"""The driver's tables seen as the eight raw marketplace tables, plus a synthetic score table.

Plain SQL that gives the same rows in Spark and in DuckDB. Keys are bigint.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from stallwise.session import durable

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

RECIPES = {
    "raw_orders": """
select o_orderkey as order_id, o_custkey as customer_id,
  case when o_orderkey % 25 = 0 then 'canceled' when o_orderkey % 40 = 1 then 'created'
       when o_orderkey % 50 = 2 then 'unavailable' when o_orderkey % 60 = 3 then 'approved'
       when o_orderkey % 45 = 4 then 'invoiced'
       when o_orderstatus = 'P' and o_orderkey % 4 = 0 then 'processing'
       when o_orderstatus = 'O' and o_orderkey % 4 = 1 then 'shipped' else 'delivered' end as order_status,
  o_orderdate + ((o_orderkey * 7) % 24) * interval '1' hour as order_purchase_timestamp,
  o_orderdate + ((o_orderkey * 7) % 24 + 1) * interval '1' hour as order_approved_at,
  case when o_orderkey % 29 = 0 then null else o_orderdate + (1 + o_orderkey % 3) * interval '1' day end as order_delivered_carrier_date,
  case when o_orderkey % 31 = 0 then null
       else o_orderdate + (1 + (o_orderkey * 13 + o_custkey) % 30) * interval '1' day
            + ((o_orderkey * 5) % 24) * interval '1' hour end as order_delivered_customer_date,
  case when o_orderkey % 53 = 0 then null else o_orderdate + (20 + o_custkey % 10) * interval '1' day end as order_estimated_delivery_date
from orders
""",
    "raw_order_items": """
select l_orderkey as order_id,
  row_number() over (partition by l_orderkey
    order by l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) as order_item_id,
  l_partkey as product_id, l_suppkey as seller_id, l_shipdate as shipping_limit_date,
  l_extendedprice as price, round(l_quantity * 1.25, 2) as freight_value
from lineitem
""",
    "raw_order_payments": """
select l_orderkey as order_id,
  row_number() over (partition by l_orderkey
    order by l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) as payment_sequential,
  case l_returnflag when 'A' then ' Credit_Card' when 'N' then 'BOLETO ' else 'voucher' end as payment_type,
  cast(l_quantity as int) % 10 + 1 as payment_installments,
  l_extendedprice as payment_value
from lineitem
""",
    "raw_order_reviews": """
select o_orderkey * 2 as review_id, o_orderkey as order_id,
  cast(substring(o_orderpriority, 1, 1) as int) as review_score,
  cast(null as varchar(10)) as review_comment_title, o_orderpriority as review_comment_message,
  o_orderdate + interval '31' day as review_creation_date,
  o_orderdate + interval '33' day as review_answer_timestamp
from orders
union all
select o_orderkey * 2 + 1, o_orderkey, 1 + cast(o_custkey % 5 as int), 'again', null,
  o_orderdate + (29 + o_orderkey % 4) * interval '1' day, o_orderdate + interval '40' day
from orders where o_orderkey % 7 = 0
""",
    "raw_customers": """
select c_custkey as customer_id, cast(floor(c_custkey / 3.0) as bigint) as customer_unique_id,
  lpad(cast(cast(floor(c_custkey / 50.0) as bigint) as varchar(12)), 8, '0') as customer_zip_code_prefix,
  concat(' ', n_name, ' ') as customer_city, lower(substring(r_name, 1, 2)) as customer_state
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
""",
    "raw_sellers": """
select s_suppkey as seller_id, lpad(cast(cast(floor(s_suppkey / 50.0) as bigint) as varchar(12)), 8, '0') as seller_zip_code_prefix,
  concat(' ', n_name, ' ') as seller_city, lower(substring(r_name, 1, 2)) as seller_state
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
""",
    "raw_products": """
select p_partkey as product_id,
  case when p_partkey % 41 = 0 then null when p_partkey % 43 = 0 then '  ' else concat(' ', p_name) end as product_category_name,
  length(p_name) as product_name_lenght, length(p_name) * 10 + p_size as product_description_lenght,
  p_size % 6 as product_photos_qty,
  case when p_partkey % 37 = 0 then null else p_retailprice end as product_weight_g,
  p_size as product_length_cm, p_size % 20 + 2 as product_height_cm,
  case when p_partkey % 47 = 0 then null else p_size % 15 + 5 end as product_width_cm
from part
""",
    "raw_geolocation": """
select lpad(cast(cast(floor(c_custkey / 50.0) as bigint) as varchar(12)), 8, '0') as geolocation_zip_code_prefix,
  c_acctbal / 1000 as geolocation_lat, c_nationkey * 1.5 as geolocation_lng,
  concat(' ', c_mktsegment) as geolocation_city, lower(substring(r_name, 1, 2)) as geolocation_state
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
""",
    "synthetic_scores": """
select order_id, cast(order_ts as date) as order_date, late as actual_is_delayed,
  cast(((order_id * 37) % 1000) * 7 + case when month(order_ts) in (3, 4, 9) then 0 else 3000 * late end as double) / 10000 as p_champion,
  cast(((order_id * 53) % 1000) * 7 + 2000 * late as double) / 10000 as p_challenger
from (
  select order_id, order_purchase_timestamp as order_ts,
    case when order_delivered_customer_date > order_estimated_delivery_date then 1 else 0 end as late
  from raw_orders
  where order_delivered_customer_date is not null and order_estimated_delivery_date is not null
) t
""",
}


def with_clauses(names: list[str], definitions: dict[str, str]) -> str:
    """WITH list of the named definitions and all they refer to, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for other in definitions:
            if other != name and re.search(rf"\b{other}\b", definitions[name]):
                visit(other)
        ordered.append(name)

    for name in names:
        visit(name)
    return "with " + ", ".join(f"{n} as ({definitions[n].strip()})" for n in ordered) if ordered else ""


def register(spark: SparkSession, sf_dir: str, names: list[str] = DRIVER_TABLES) -> None:
    for name in names:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def recipe(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived table; only the driver tables it reads are opened."""
    text = with_clauses([name], RECIPES)
    register(spark, sf_dir, [t for t in DRIVER_TABLES if re.search(rf"\bfrom {t}\b|\bjoin {t}\b", text)])
    return spark.sql(f"{text} select * from {name}")


# The number of a line within its order, as it stands in both recipes that read the lines.
LINE_NUMBER = re.search(r"row_number\(\).*?\)(?= as order_item_id)", RECIPES["raw_order_items"], re.DOTALL).group()


class RawTables(dict):
    """The raw tables by source name, derived when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        super().__init__()
        self._spark, self._sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        self[name] = recipe(self._spark, self._sf_dir, f"raw_{name}")
        return self[name]

    def with_stored_lines(self) -> RawTables:
        """For readers of both tables that are made of the lines: these are numbered once, in one shuffle, and stored."""
        register(self._spark, self._sf_dir, ["lineitem"])
        columns = "l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_shipdate"
        lines = durable(self._spark.sql(f"select {columns}, {LINE_NUMBER} as l_number from lineitem"))
        for name in ("order_items", "order_payments"):
            text = RECIPES[f"raw_{name}"].replace(LINE_NUMBER, "l_number").replace("from lineitem", "from {lines}")
            self[name] = self._spark.sql(text, lines=lines)
        return self


def synthetic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_id, order_date, actual_is_delayed, p_champion, p_challenger; ties and empty signal included."""
    return recipe(spark, sf_dir, "synthetic_scores")
