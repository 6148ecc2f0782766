"""The whole build: raw tables to staging, marts, metrics and features.

When a path is given every layer is stored: the marts, the features and the quality suite each read staging and
intermediate tables again. The quality contract's counts of a table are observed as it is written. Without a path all stays lazy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stallwise.plans import features, marts, metrics, quality, staging
from stallwise.sources import sinks

STAGING = {
    "orders": staging.stg_orders,
    "order_items": staging.stg_order_items,
    "order_payments": staging.stg_order_payments,
    "order_reviews": staging.stg_order_reviews,
    "customers": staging.stg_customers,
    "sellers": staging.stg_sellers,
    "products": staging.stg_products,
    "geolocation": staging.stg_geolocation,
}


class StagedTables(dict):
    """The cleaned tables by name, planned when first asked for."""

    def __init__(self, raw: dict[str, DataFrame]) -> None:
        super().__init__()
        self._raw = raw

    def __missing__(self, name: str) -> DataFrame:
        source = name.removeprefix("stg_")
        self[name] = STAGING[source](self._raw[source])
        return self[name]


def stage(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    staged = StagedTables(raw)
    return {name: staged[name] for name in (f"stg_{source}" for source in STAGING)}


def intermediate(stg: dict[str, DataFrame], aggregated: DataFrame | None = None) -> dict[str, DataFrame]:
    return {
        "payments_aggregated": marts.payments_aggregated(stg["stg_order_payments"]),
        "order_status_normalized": marts.order_status_normalized(stg["stg_orders"]),
        "int_orders_enriched": marts.int_orders_enriched(
            stg["stg_orders"], stg["stg_order_payments"], stg["stg_order_reviews"], aggregated
        ),
    }


def order_core(stg: dict[str, DataFrame], aggregated: DataFrame | None = None) -> DataFrame:
    return marts.order_core(
        stg["stg_orders"], stg["stg_order_payments"], stg["stg_order_items"], stg["stg_customers"], aggregated
    )


class Tables(dict):
    """Datasets by name, and what the quality contract counts in them, observed while they were written."""

    def __init__(self) -> None:
        super().__init__()
        self.observed: dict[str, dict[str, object]] = {}


def build(raw: dict[str, DataFrame], path: str | None = None, as_of: Column | None = None) -> Tables:
    """All datasets by name; stored under ``path`` when given, lazy otherwise. ``as_of`` is the time for the check on the future."""
    tables = Tables()
    counted = quality.declared(quality.Unplanned(), F.current_timestamp() if as_of is None else as_of) if path else None

    def keep(name: str, df: DataFrame) -> DataFrame:
        if path is None:
            return df
        counts = counted.pass_columns(name)
        if not counts:
            return sinks.overwrite(df, f"{path}/{name}")
        seen = Observation(f"quality of {name}")
        stored = sinks.overwrite(df.observe(seen, *counts), f"{path}/{name}")
        tables.observed[name] = seen.get
        return stored

    stg = {name: keep(name, df) for name, df in stage(raw).items()}
    tables.update(stg)
    tables["payments_aggregated"] = keep("payments_aggregated", marts.payments_aggregated(stg["stg_order_payments"]))
    # what is looked up by order_id is looked up once: the enriched orders, the core and the fact are reads of one stored table
    wide = keep("orders_wide", marts.orders_wide(stg["stg_orders"], tables["payments_aggregated"], stg["stg_order_reviews"], stg["stg_order_items"]))
    tables["order_status_normalized"] = keep("order_status_normalized", marts.order_status_normalized(stg["stg_orders"]))
    tables["int_orders_enriched"] = keep("int_orders_enriched", wide.select(*marts.ENRICHED_COLUMNS))
    tables["dim_customers"] = keep("dim_customers", marts.dim_customers(stg["stg_customers"]))
    tables["dim_sellers"] = keep("dim_sellers", marts.dim_sellers(stg["stg_sellers"]))
    tables["dim_products"] = keep("dim_products", marts.dim_products(stg["stg_products"]))
    reviewed = keep("order_core", marts.core_of(wide, stg["stg_customers"]))
    core = reviewed.drop("review_score")
    tables["order_core"] = core
    tables["fact_orders"] = keep("fact_orders", marts.fact_orders(marts.with_category(reviewed, stg["stg_products"])))
    tables["fact_order_items"] = keep(
        "fact_order_items",
        marts.fact_order_items(stg["stg_order_items"], tables["dim_products"], tables["dim_sellers"]),
    )
    tables["met_daily_gmv"] = keep("met_daily_gmv", metrics.met_daily_gmv(core))
    tables["met_daily_revenue"] = keep("met_daily_revenue", metrics.met_daily_revenue(core))
    tables["met_daily_delay_rate"] = keep("met_daily_delay_rate", metrics.met_daily_delay_rate(core))
    tables["order_features"] = keep(
        "order_features",
        features.order_features(core, tables["dim_customers"], tables["dim_sellers"], tables["dim_products"], stored=bool(path)),
    )
    return tables
