"""Oracle SQL: the same results as ``query_registry``, in DuckDB SQL over the driver's tables.

``MODELS`` are named definitions that build on the raw-table recipes; ``ANSWERS`` maps a query key to its
final select. Only the definitions an answer needs are put into its WITH list.
"""

from __future__ import annotations

from driver_tables import RECIPES, with_clauses
from query_registry import (
    AS_OF,
    BASELINE_AUC,
    EXTENDED_END,
    MINIMUM_AUC,
    RUN_STAMP,
    TEST_START,
    VALIDATION_START,
    VERSION,
)
from stallwise import contract

# The schemas and constraints that the results must have, stated here on their own.
ENRICHED_COLUMNS = ['order_id', 'customer_id', 'order_purchased_at', 'order_approved_at', 'order_delivered_carrier_at',
 'order_delivered_customer_at', 'order_estimated_delivery_at', 'order_status', 'normalized_status', 'is_delivered',
 'is_canceled', 'total_payment_value', 'payment_installments_max', 'payment_method_count', 'payment_type_list',
 'payment_count', 'review_score', 'review_comment_title', 'review_comment_message', 'delivery_days',
 'estimated_delivery_days', 'delay_days', 'is_delayed']
FACT_COLUMNS = ['order_id', 'customer_key', 'order_date', 'delivery_date', 'estimated_delivery_date', 'item_count',
 'total_freight_value', 'product_category', 'seller_id', 'total_payment_value', 'delivery_days', 'delay_days',
 'is_delayed', 'review_score']
FEATURE_COLUMNS = ['order_id', 'order_purchase_timestamp', 'order_day_of_week', 'order_hour', 'order_month', 'total_payment_value',
 'payment_installments', 'payment_type_count', 'product_weight_g', 'product_volume_cm3', 'product_category',
 'customer_state', 'seller_state', 'customer_seller_same_state', 'seller_avg_delivery_days_historical',
 'freight_value', 'freight_ratio', 'estimated_delivery_days', 'seller_id', 'is_delayed']
LEAK_REASONS = {'label_unexpected': 'is_delayed present but order not eligible for delay label',
 'label_absent': 'is_delayed null but order eligible for delay label',
 'history_early': 'first seller order must have null historical avg'}
NOT_NULL = {'stg_orders': ['order_id', 'customer_id', 'order_status', 'order_purchased_at'],
 'stg_order_items': ['order_id', 'item_sequence', 'product_id', 'seller_id', 'price', 'freight_value'],
 'stg_order_payments': ['order_id', 'payment_sequence', 'payment_type', 'payment_installments', 'payment_value'],
 'stg_order_reviews': ['review_id', 'order_id', 'review_score'],
 'stg_customers': ['customer_id', 'customer_unique_id', 'customer_zip_code_prefix', 'customer_city',
                   'customer_state'],
 'stg_sellers': ['seller_id', 'seller_zip_code_prefix', 'seller_city', 'seller_state'],
 'stg_products': ['product_id', 'product_category_name'],
 'stg_geolocation': ['zip_code_prefix', 'latitude', 'longitude', 'city', 'state'],
 'payments_aggregated': ['order_id', 'total_payment_value', 'payment_installments_max', 'payment_method_count',
                         'payment_type_list', 'payment_count'],
 'order_status_normalized': ['order_id', 'raw_status', 'normalized_status', 'is_delivered', 'is_canceled'],
 'int_orders_enriched': ['order_id', 'customer_id', 'order_purchased_at', 'order_status', 'normalized_status',
                         'is_delivered', 'is_canceled'],
 'dim_customers': ['customer_key', 'customer_unique_id'],
 'dim_sellers': ['seller_key', 'seller_id'],
 'dim_products': ['product_key', 'product_id'],
 'fact_orders': ['order_id', 'customer_key'],
 'fact_order_items': ['order_id', 'order_item_id', 'product_id', 'seller_id', 'product_key', 'seller_key'],
 'met_daily_gmv': ['order_date', 'gmv'],
 'met_daily_revenue': ['order_date', 'revenue'],
 'met_daily_delay_rate': ['order_date', 'delay_rate', 'delivered_eligible_orders', 'delayed_orders'],
 'order_features': ['order_id', 'order_purchase_timestamp'],
 'fct_predictions': ['order_id', 'predicted_probability', 'predicted_class', 'model_version',
                     'prediction_timestamp']}
UNIQUE = [('stg_orders', ['order_id']), ('stg_customers', ['customer_id']), ('stg_sellers', ['seller_id']),
 ('stg_products', ['product_id']), ('stg_geolocation', ['zip_code_prefix']), ('payments_aggregated', ['order_id']),
 ('order_status_normalized', ['order_id']), ('int_orders_enriched', ['order_id']),
 ('dim_customers', ['customer_key']), ('dim_customers', ['customer_unique_id']), ('dim_sellers', ['seller_key']),
 ('dim_sellers', ['seller_id']), ('dim_products', ['product_key']), ('dim_products', ['product_id']),
 ('fact_orders', ['order_id']), ('met_daily_gmv', ['order_date']), ('met_daily_revenue', ['order_date']),
 ('met_daily_delay_rate', ['order_date']), ('order_features', ['order_id']), ('fct_predictions', ['order_id']),
 ('stg_order_items', ['order_id', 'item_sequence']), ('stg_order_payments', ['order_id', 'payment_sequence']),
 ('fact_order_items', ['order_id', 'order_item_id'])]
ACCEPTED = [('stg_orders', 'order_status',
  ['delivered', 'shipped', 'invoiced', 'processing', 'canceled', 'unavailable', 'created', 'approved']),
 ('stg_order_payments', 'payment_type', ['credit_card', 'boleto', 'voucher', 'debit_card', 'not_defined']),
 ('stg_order_reviews', 'review_score', [1, 2, 3, 4, 5]),
 ('order_status_normalized', 'normalized_status', ['placed', 'in_transit', 'delivered', 'canceled', 'other']),
 ('order_status_normalized', 'is_delivered', [0, 1]), ('order_status_normalized', 'is_canceled', [0, 1]),
 ('fct_predictions', 'predicted_class', [0, 1])]
RELATIONSHIPS = [('stg_order_items', 'order_id', 'stg_orders', 'order_id'),
 ('fact_orders', 'customer_key', 'dim_customers', 'customer_key'),
 ('fact_order_items', 'product_id', 'dim_products', 'product_id'),
 ('fact_order_items', 'seller_id', 'dim_sellers', 'seller_id'),
 ('fact_order_items', 'product_key', 'dim_products', 'product_key'),
 ('fact_order_items', 'seller_key', 'dim_sellers', 'seller_key')]

NUMERIC, CATEGORICAL = contract.NUMERIC_FEATURES, contract.CATEGORICAL_FEATURES


def quoted(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


def amount(expression: str) -> str:
    """Sum of doubles rounded once: multiples of 2^-80 add up exactly as whole numbers, whose text is the nearest double's."""
    return f"cast(cast(sum(cast(({expression}) * pow(2, 80) as hugeint)) as varchar) as double) / pow(2, 80)"


def ratio(top: str, bottom: str) -> str:
    return f"cast({top} as double) / nullif(cast({bottom} as double), 0)"


def key_of(*columns: str) -> str:
    parts = [f"coalesce(cast({c} as varchar), '{contract.KEY_NULL_MARKER}')" for c in columns]
    return f"md5(concat_ws('-', {', '.join(parts)}))"


def band(value: str, warning: float, alert: float) -> str:
    return (
        f"case when {value} is null then 'unknown' when {value} < {warning} then 'ok' "
        f"when {value} < {alert} then 'warning' else 'alert' end"
    )


def confusion(label: str = "actual_is_delayed", guess: str = "predicted_class") -> str:
    pairs = {"tp": (1, 1), "fp": (0, 1), "fn": (1, 0), "tn": (0, 0)}
    return ", ".join(
        f"cast(count(*) filter (where {label} = {a} and {guess} = {g}) as bigint) as {name}"
        for name, (a, g) in pairs.items()
    )


RATES = """coalesce(cast(tp as double) / nullif(tp + fp, 0), 0) as "precision",
    coalesce(cast(tp as double) / nullif(tp + fn, 0), 0) as recall,
    coalesce(cast(2 * tp as double) / nullif(2 * tp + fp + fn, 0), 0) as f1"""


def auc_model(source: str, score: str, group: str) -> str:
    """(grp, auc): per score late rows and rows on time, then pairs by running sums."""
    return f"""select grp, cast(sum(cast(late as hugeint) * (2 * (upto - ontime) + ontime)) as double)
        / nullif(2.0 * sum(late) * sum(ontime), 0) as auc
      from (select grp, late, ontime, sum(ontime) over (partition by grp order by score) as upto
        from (select {group} as grp, {score} as score, sum(actual_is_delayed) as late,
            sum(1 - actual_is_delayed) as ontime from {source} group by 1, 2) g1) g2
      group by grp"""


def report(auc: str, counts: str) -> str:
    """(grp, n_rows, roc_auc, rates, counts) from an auc model and a counts model."""
    return f"""select c.grp, tp + fp + fn + tn as n_rows, auc as roc_auc, {RATES}, tp, fp, fn, tn
      from {counts} c join {auc} a on a.grp = c.grp"""


def split_of(time: str, validation: str = VALIDATION_START, test: str = TEST_START) -> str:
    return (
        f"case when {time} < timestamp '{validation}' then 'train' "
        f"when {time} < timestamp '{test}' then 'validation' else 'test' end"
    )


def long_numbers(source: str, flag: int) -> str:
    return " union all ".join(
        f"select '{f}' as feature, cast({f} as double) as v, {flag} as base from {source}" for f in NUMERIC
    )


def long_texts(source: str, flag: int, null: str) -> str:
    return " union all ".join(
        f"select '{f}' as feature, coalesce({f}, '{null}') as v, {flag} as base from {source}" for f in CATEGORICAL
    )


def drift_models(name: str, current: str) -> dict[str, str]:
    """Models n_<name>_* of numeric and c_<name>_* of categorical drift of ``current`` against x_train."""
    n, c = f"n_{name}", f"c_{name}"
    bins = contract.PSI_BINS
    return {
        f"{n}_values": f"select * from ({long_numbers('x_train', 1)} union all {long_numbers(current, 0)}) u "
        "where v is not null",
        f"{n}_sorted": f"select feature, v, row_number() over (partition by feature order by v) - 1 as pos, "
        f"count(*) over (partition by feature) as n from {n}_values where base = 1",
        f"{n}_quantiles": f"""select w.feature, w.i, lo.v + (hi.v - lo.v) * (cast(w.rest as double) / {bins}.0) as edge
          from (select feature, i, ((n - 1) * i) // {bins} as low, ((n - 1) * i) % {bins} as rest,
              least(((n - 1) * i) // {bins} + 1, n - 1) as high
            from (select distinct feature, n from {n}_sorted) s, range(0, {bins + 1}) r(i)) w
          join {n}_sorted lo on lo.feature = w.feature and lo.pos = w.low
          join {n}_sorted hi on hi.feature = w.feature and hi.pos = w.high""",
        f"{n}_edges": f"select feature, edge, row_number() over (partition by feature order by edge) - 1 as position, "
        f"count(*) over (partition by feature) as n_edges "
        f"from (select distinct feature, edge from {n}_quantiles) q",
        f"{n}_bins": f"""select b.feature, b.position + 1 as bin, b.edge as low, e.edge as high,
            b.position + 2 = b.n_edges as is_last
          from {n}_edges b join {n}_edges e on e.feature = b.feature and e.position = b.position + 1""",
        f"{n}_histogram": f"""select b.feature, b.bin, sum(base) as baseline_n, sum(1 - base) as current_n
          from {n}_bins b join {n}_values x on x.feature = b.feature and x.v >= b.low
            and (x.v < b.high or (b.is_last and x.v = b.high)) group by 1, 2""",
        f"{n}_psi": f"""select f.feature, case when bn >= {bins} and cn >= {contract.PSI_MIN_CURRENT_ROWS}
            and n_edges >= {contract.PSI_MIN_EDGES} then psi end as psi
          from (select unnest([{quoted(NUMERIC)}]) as feature) f
          left join (select feature, sum(base) as bn, sum(1 - base) as cn from {n}_values group by 1) s
            on s.feature = f.feature
          left join (select distinct feature, n_edges from {n}_edges) k on k.feature = f.feature
          left join (select feature, sum((a - e) * ln(a / e)) as psi
            from (select feature,
                greatest(least(cast(baseline_n as double) / greatest(sum(baseline_n) over (partition by feature), 1), 1.0), 1e-6) as e,
                greatest(least(cast(current_n as double) / greatest(sum(current_n) over (partition by feature), 1), 1.0), 1e-6) as a
              from {n}_histogram) h group by feature) p on p.feature = f.feature""",
        f"{c}_shares": f"""select feature, v as category, {ratio('b', 'sum(b) over (partition by feature)')} as baseline_share,
            {ratio('c', 'sum(c) over (partition by feature)')} as current_share
          from (select feature, v, sum(base) as b, sum(1 - base) as c
            from ({long_texts('x_train', 1, contract.NULL_CATEGORY)} union all
              {long_texts(current, 0, contract.NULL_CATEGORY)}) u group by 1, 2) t""",
        f"{c}_ranked": f"""select *, abs(current_share - baseline_share) as abs_diff,
            row_number() over (partition by feature order by abs(current_share - baseline_share) desc, category) as rank
          from {c}_shares""",
        f"{c}_worst": f"select feature, {band('abs_diff', contract.SHARE_WARNING, contract.SHARE_ALERT)} as status, "
        f"abs_diff as max_abs_share_diff, category as worst_category from {c}_ranked where rank = 1",
        f"overall_{name}": f"""select case max(level) when 2 then 'alert' when 1 then 'warning' else 'ok' end as overall_status
          from (select case {band('psi', contract.PSI_WARNING, contract.PSI_ALERT)}
                when 'alert' then 2 when 'warning' then 1 else 0 end as level from {n}_psi
            union all
            select case status when 'alert' then 2 when 'warning' then 1 else 0 end from {c}_worst) l""",
    }


STATUS = """case {s} {branches} else '{other}' end""".format(
    s="order_status",
    branches=" ".join(
        f"when '{member}' then '{group}'" for group, members in contract.STATUS_GROUPS.items() for member in members
    ),
    other=contract.OTHER_STATUS,
)

MODELS = {
    # ---- cleaned tables
    "s_orders": """select order_id, customer_id, order_status, order_purchase_timestamp as order_purchased_at,
        order_approved_at, order_delivered_carrier_date as order_delivered_carrier_at,
        order_delivered_customer_date as order_delivered_customer_at,
        order_estimated_delivery_date as order_estimated_delivery_at from raw_orders""",
    "s_items": """select order_id, cast(order_item_id as int) as item_sequence, product_id, seller_id,
        shipping_limit_date as shipping_limit_at, price, freight_value from raw_order_items""",
    "s_payments": """select order_id, cast(payment_sequential as int) as payment_sequence, lower(trim(payment_type)) as payment_type,
        payment_installments, payment_value from raw_order_payments""",
    "s_reviews": """select review_id, order_id, review_score, review_comment_title, review_comment_message,
        review_creation_date as review_created_at, review_answer_timestamp as review_answered_at
        from raw_order_reviews""",
    "s_customers": """select customer_id, customer_unique_id, customer_zip_code_prefix,
        lower(trim(customer_city)) as customer_city, upper(customer_state) as customer_state from raw_customers""",
    "s_sellers": """select seller_id, seller_zip_code_prefix, lower(trim(seller_city)) as seller_city,
        upper(seller_state) as seller_state from raw_sellers""",
    "s_products": f"""select product_id, coalesce(lower(trim(product_category_name)), '{contract.NO_CATEGORY}')
          as product_category_name,
        cast(product_name_lenght as int) as product_name_length,
        cast(product_description_lenght as int) as product_description_length, product_photos_qty,
        product_weight_g as weight_g, cast(product_length_cm as double) as length_cm,
        cast(product_height_cm as double) as height_cm, cast(product_width_cm as double) as width_cm
        from raw_products""",
    "g_city": """select zip, city from (select geolocation_zip_code_prefix as zip, geolocation_city as city, count(*) as n
        from raw_geolocation group by 1, 2) t
        qualify row_number() over (partition by zip order by n desc, city) = 1""",
    "g_state": """select zip, state from (select geolocation_zip_code_prefix as zip, geolocation_state as state,
        count(*) as n from raw_geolocation group by 1, 2) t
        qualify row_number() over (partition by zip order by n desc, state) = 1""",
    "s_geolocation": """select g.geolocation_zip_code_prefix as zip_code_prefix, avg(geolocation_lat) as latitude,
        avg(geolocation_lng) as longitude, lower(trim(min(g_city.city))) as city, upper(min(g_state.state)) as state
        from raw_geolocation g join g_city on g_city.zip = g.geolocation_zip_code_prefix
        join g_state on g_state.zip = g.geolocation_zip_code_prefix group by 1""",
    # ---- intermediate results
    "o_payments": f"""select order_id, {amount('payment_value')} as total_payment_value,
        max(payment_installments) as payment_installments_max, count(distinct payment_type) as payment_method_count,
        string_agg(distinct payment_type, ', ' order by payment_type) as payment_type_list,
        count(*) as payment_count from s_payments group by order_id""",
    "o_delays": f"""select *, {STATUS} as normalized_status,
        case order_status when 'delivered' then 1 else 0 end as is_delivered,
        case order_status when 'canceled' then 1 else 0 end as is_canceled,
        case when order_status = 'delivered' then
          cast(cast(order_delivered_customer_at as date) - cast(order_purchased_at as date) as int) end as delivery_days,
        cast(cast(order_estimated_delivery_at as date) - cast(order_purchased_at as date) as int)
          as estimated_delivery_days,
        case when order_status = 'delivered' then
          cast(cast(order_delivered_customer_at as date) - cast(order_estimated_delivery_at as date) as int) end
          as delay_days,
        case when order_status = 'delivered' then
          cast(order_delivered_customer_at > order_estimated_delivery_at as int) end as is_delayed
        from s_orders""",
    "o_review": """select * from s_reviews
        qualify row_number() over (partition by order_id order by review_created_at desc nulls last, review_id) = 1""",
    "o_enriched": f"""select {', '.join(ENRICHED_COLUMNS)}
        from o_delays left join o_payments using (order_id)
        left join (select order_id, review_score, review_comment_title, review_comment_message from o_review) r
          using (order_id)""",
    "i_rollup": f"""select order_id, count(*) as item_count, {amount('freight_value')} as total_freight_value
        from s_items group by order_id""",
    "p_category": f"""select product_id,
        case when trim(product_category_name) = '' then '{contract.NO_CATEGORY}' else trim(product_category_name) end
          as product_category from s_products""",
    "i_primary": f"""select order_id, seller_id, product_id, price + freight_value as line_value,
        coalesce(product_category, '{contract.NO_CATEGORY}') as product_category
        from s_items left join p_category using (product_id)
        qualify row_number() over (partition by order_id order by price + freight_value desc, item_sequence) = 1""",
    # ---- dimensions and facts
    "d_customers": f"""select {key_of('customer_unique_id')} as customer_key, customer_unique_id, customer_city,
        customer_state, customer_zip_code_prefix from s_customers
        qualify row_number() over (partition by customer_unique_id order by customer_id) = 1""",
    "d_sellers": f"""select {key_of('seller_id')} as seller_key, seller_id, seller_city, seller_state,
        seller_zip_code_prefix from s_sellers""",
    "d_products": f"""select {key_of('product_id')} as product_key, product_id, product_category, weight_g, length_cm,
        height_cm, width_cm from s_products join p_category using (product_id)""",
    "f_items": """select order_id, item_sequence as order_item_id, product_id, seller_id, product_key, seller_key, price,
        freight_value from s_items join d_products using (product_id) join d_sellers using (seller_id)""",
    "f_core": """select e.*, d.customer_key, d.customer_state, cast(e.order_purchased_at as date) as order_date,
        cast(e.order_delivered_customer_at as date) as delivery_date,
        cast(e.order_estimated_delivery_at as date) as estimated_delivery_date,
        coalesce(item_count, 0) as item_count, coalesce(total_freight_value, 0) as total_freight_value,
        i.seller_id, i.product_id, i.product_category
        from o_enriched e join s_customers c using (customer_id) join d_customers d using (customer_unique_id)
        left join i_rollup using (order_id) left join i_primary i using (order_id)""",
    "f_orders": f"select {', '.join(FACT_COLUMNS)} from f_core",
    # ---- metrics
    "v_valid": f"""select * from f_core where order_status in ({quoted(contract.VALID_STATUSES)}) and item_count > 0
        and order_date is not null""",
    "v_eligible": """select * from f_core where order_status = 'delivered' and is_delayed is not null
        and delivery_date is not null and estimated_delivery_date is not null and order_date is not null""",
    "m_gmv": f"select order_date, {amount('coalesce(total_payment_value, 0)')} as gmv from v_valid group by 1",
    "m_revenue": f"""select order_date, {amount('coalesce(total_payment_value, 0)')} as revenue from v_valid
        where order_status = 'delivered' group by 1""",
    "m_delay": """select order_date, avg(cast(is_delayed as double)) as delay_rate,
        count(*) as delivered_eligible_orders, count(*) filter (where is_delayed = 1) as delayed_orders
        from v_eligible group by 1""",
    # ---- features
    "x_history": """select order_id, seller_id, avg(delivery_days) over (partition by seller_id
        order by order_purchased_at, order_id rows between unbounded preceding and 1 preceding)
          as seller_avg_delivery_days_historical from f_core""",
    "x_features": f"""select f.order_id, f.order_purchased_at as order_purchase_timestamp,
        cast(extract(dow from f.order_purchased_at) as int) as order_day_of_week,
        cast(extract(hour from f.order_purchased_at) as int) as order_hour,
        cast(extract(month from f.order_purchased_at) as int) as order_month,
        f.total_payment_value, f.payment_installments_max as payment_installments,
        f.payment_method_count as payment_type_count, p.weight_g as product_weight_g,
        p.length_cm * p.height_cm * p.width_cm as product_volume_cm3, p.product_category, f.customer_state,
        s.seller_state, cast(f.customer_state = s.seller_state as int) as customer_seller_same_state,
        h.seller_avg_delivery_days_historical, f.total_freight_value as freight_value,
        {ratio('f.total_freight_value', 'f.total_payment_value')} as freight_ratio, f.estimated_delivery_days,
        f.seller_id, f.is_delayed
        from f_core f join x_history h on h.order_id = f.order_id
        left join d_sellers s on s.seller_id = f.seller_id left join d_products p on p.product_id = f.product_id""",
    "x_labelled": f"select *, {split_of('order_purchase_timestamp')} as split from x_features where is_delayed is not null",
    "x_train": f"select {', '.join(FEATURE_COLUMNS)} from x_labelled where split = 'train'",
    "x_current": "select * from x_features",
    # ---- a linear model whose weights follow from counts
    "y_train": "select * from x_labelled where split = 'train'",
    "y_vocabulary": f"""select feature, v as category, n_rows, cast(case
          when n_values < {contract.MAX_CATEGORIES} or place < {contract.MAX_CATEGORIES} then row_number() over (
            partition by feature, n_values < {contract.MAX_CATEGORIES} or place < {contract.MAX_CATEGORIES} order by v) - 1
          else {contract.MAX_CATEGORIES - 1} end as int) as slot
        from (select feature, v, n_rows, count(*) over (partition by feature) as n_values,
            row_number() over (partition by feature order by n_rows desc, v desc) as place
          from (select feature, v, count(*) as n_rows
            from ({long_texts('x_train', 1, contract.MISSING_CATEGORY)}) l group by 1, 2) c) p""",
    "y_medians": f"select {', '.join(f'median({c}) as {c}' for c in NUMERIC)} from y_train",
    "y_weights": "select " + ", ".join(
        f"""round(count(*) filter (t.is_delayed = 1 and t.{c} > m.{c}) / cast(count(*) filter (t.is_delayed = 1) as double)
        - count(*) filter (t.is_delayed = 0 and t.{c} > m.{c}) / cast(count(*) filter (t.is_delayed = 0) as double), 6) as {c}"""
        for c in NUMERIC
    ) + """, round(ln(count(*) filter (t.is_delayed = 1) / cast(count(*) filter (t.is_delayed = 0) as double)), 6) as intercept,
        count(*) filter (t.is_delayed = 1) / cast(count(*) as double) as rate from y_train t, y_medians m""",
    "y_slots": f"""select l.feature, v.slot, min(case when v.slot = {contract.MAX_CATEGORIES - 1} then 'infrequent' else v.category end) as label,
        round(avg(l.late) - min(w.rate), 6) as weight
        from ({" union all ".join(f"select '{c}' as feature, coalesce({c}, '{contract.MISSING_CATEGORY}') as category, cast(is_delayed as double) as late from y_train" for c in CATEGORICAL)}) l
        join y_vocabulary v on v.feature = l.feature and v.category = l.category, y_weights w group by 1, 2""",
    "y_coefficients": " union all ".join(f"select '{c}' as feature, {c} as coefficient from y_weights" for c in NUMERIC)
    + " union all select feature || '=' || label, weight from y_slots",
    "y_scored": "select f.order_id, 1 / (1 + exp(-(w.intercept"
    + "".join(f" + w.{c} * coalesce(cast(f.{c} as double), m.{c})" for c in NUMERIC)
    + "".join(f" + coalesce(s{i}.weight, 0)" for i in range(len(CATEGORICAL)))
    + "))) as p from x_features f cross join y_weights w cross join y_medians m"
    + "".join(
        f""" left join y_vocabulary v{i} on v{i}.feature = '{c}' and v{i}.category = coalesce(f.{c}, '{contract.MISSING_CATEGORY}')
        left join y_slots s{i} on s{i}.feature = '{c}' and s{i}.slot = v{i}.slot"""
        for i, c in enumerate(CATEGORICAL)
    ),
    "x_shifted": """select * replace (total_payment_value * 1.5e0 as total_payment_value,
        case when order_id % 4 = 0 then 'special' else product_category end as product_category) from x_current""",
    # ---- scores
    "z_scores": f"""select *, cast(p_champion >= {contract.CLASS_THRESHOLD} as int) as predicted_class,
        cast(p_challenger >= {contract.CLASS_THRESHOLD} as int) as challenger_class, strftime(order_date, '%Y-%m') as period,
        {split_of('order_date')} as split, {split_of('order_date', EXTENDED_END)} as ext_split
        from synthetic_scores""",
    "z_bridge": f"""select z.order_id, z.p_champion as predicted_probability, z.predicted_class,
        '{VERSION}' as model_version, timestamp '{RUN_STAMP}' as prediction_timestamp, f.customer_key, f.order_date,
        f.is_delayed as actual_is_delayed from z_scores z left join f_core f on f.order_id = z.order_id""",
    "q_auc_split": auc_model("z_scores", "p_champion", "split"),
    "q_cm_split": f"select split as grp, {confusion()} from z_scores group by 1",
    "q_split": report("q_auc_split", "q_cm_split"),
    "q_auc_month": auc_model("z_scores", "p_champion", "period"),
    "q_cm_month": f"select period as grp, {confusion()} from z_scores group by 1",
    "q_month": f"""select *, coalesce(roc_auc < {BASELINE_AUC} - {contract.AUC_ALERT_DELTA}e0, false) as alert
        from ({report('q_auc_month', 'q_cm_month')}) m""",
    "q_auc_all": auc_model("z_scores", "p_champion", "1"),
    "q_cm_all": f"select 1 as grp, {confusion()} from z_scores",
    "q_all": report("q_auc_all", "q_cm_all"),
    "q_auc_new": auc_model("z_scores", "p_challenger", "split"),
    "q_cm_new": f"select split as grp, {confusion(guess='challenger_class')} from z_scores group by 1",
    "q_new": report("q_auc_new", "q_cm_new"),
    "q_auc_ext": auc_model("z_scores", "p_challenger", "ext_split"),
    "q_cm_ext": f"select ext_split as grp, {confusion(guess='challenger_class')} from z_scores group by 1",
    "q_ext": report("q_auc_ext", "q_cm_ext"),
    "q_top": f"""select cast(k as bigint) as k, avg(cast(actual_is_delayed as double)) as precision_at_k
        from (select actual_is_delayed, row_number() over (order by p_champion desc, order_id) as place,
            greatest(1, ceil({contract.TOP_FRACTION}e0 * count(*) over ())) as k from z_scores) t
        where place <= k group by k""",
    "q_cost": f"""select tn as true_negatives, fp as false_positives, fn as false_negatives, tp as true_positives,
        fp * {contract.FALSE_POSITIVE_COST}e0 as estimated_cost_false_positives,
        fn * {contract.FALSE_NEGATIVE_COST}e0 as estimated_cost_false_negatives,
        fp * {contract.FALSE_POSITIVE_COST}e0 + fn * {contract.FALSE_NEGATIVE_COST}e0 as estimated_total_cost,
        {contract.FALSE_NEGATIVE_COST}e0 / {contract.FALSE_POSITIVE_COST}e0 as cost_ratio_fn_to_fp from q_cm_all""",
    **drift_models("test", "x_current"),
    **drift_models("shift", "x_shifted"),
    # ---- retraining
    "r_runs": """select coalesce(max(length), 0) as longest_run from (
        select count(*) as length from (
          select alert, row_number() over (order by grp) - row_number() over (partition by alert order by grp) as island
          from q_month) t where alert group by island) u""",
    "r_registry": f"""select '{VERSION}' as version, max(z.order_date) filter (where z.split = 'train') as trained_on,
        date '{VALIDATION_START}' as train_cutoff, date '{TEST_START}' - 1 as validation_end, date '{TEST_START}' as test_start,
        'train_{VERSION}' as train_snapshot,
        count(*) filter (where z.split = 'train') as train_rows,
        count(*) filter (where z.split = 'validation') as validation_rows,
        count(*) filter (where z.split = 'test') as test_rows,
        """
    + ", ".join(
        f'(select "{m}" from q_split where grp = \'{name}\') as {m}_{short}'
        for short, name in (("val", "validation"), ("test", "test"))
        for m in ("roc_auc", "precision", "recall", "f1")
    )
    + " from z_scores z",
    "r_months": """select (year(last_day) - year(trained_on)) * 12 + month(last_day) - month(trained_on) as months
        from r_registry, (select max(order_purchased_at) as last_day from s_orders) o""",
    "r_triggers": f"""select 'performance' as trigger_name, cast(longest_run as bigint) as measured,
          cast({contract.RETRAIN_ALERT_MONTHS} as bigint) as needed from r_runs
        union all select 'drift', count(*) filter (where psi >= {contract.RETRAIN_PSI}), {contract.RETRAIN_PSI_FEATURES}
          from n_shift_psi
        union all select 'calendar', months, {contract.RETRAIN_MONTHS} from r_months""",
    "r_fired": "select *, cast(measured >= needed as int) as fired from r_triggers",
    "r_compare": "select "
    + ", ".join(
        f'{side}."{m}" as {name}_{m}'
        for side, name in (("o", "champion"), ("n", "challenger"))
        for m in ("roc_auc", "precision", "recall", "f1")
    )
    + ", "
    + ", ".join(f'n."{m}" - o."{m}" as delta_{m}' for m in ("roc_auc", "precision", "recall", "f1"))
    + """, cast(n.roc_auc is not null and (o.roc_auc is null or n.roc_auc > o.roc_auc) as int) as promoted
        from q_split o join q_new n on n.grp = o.grp where o.grp = 'test'""",
}


def promoted_or(new: str, old: str) -> str:
    return f"case when c.promoted = 1 then {new} else r.{old} end as {old}"


def ext_rows(split: str) -> str:
    return f"(select count(*) from z_scores where ext_split = '{split}')"


def ext_metric(metric: str) -> str:
    return f"(select \"{metric}\" from q_ext where grp = 'validation')"


ANSWERS = {
    # ---- scans and sinks
    "scan_csv": """select review_id, order_id, review_score, review_comment_title,
        'said "' || review_comment_message || '", twice' || chr(10) || 'and left' as review_comment_message,
        review_created_at, review_answered_at from s_reviews""",
    "scan_bound_source": "select * from s_sellers",
    "load_sources_audit": " union all ".join(
        f"select '{t}' as table_name, count(*) as n_rows from raw_{t}"
        for t in ("customers", "sellers", "products", "geolocation")
    ),
    "scan_parquet": f"""select l_returnflag, count(*) as n_rows, max(l_shipdate) as last_shipdate from lineitem
        where l_shipdate >= timestamp '{TEST_START}' group by 1""",
    "sink_overwrite": "select * from m_gmv",
    "export_features": "select * from x_features",
    "sink_predictions": f"""select order_id, p_champion as predicted_probability, predicted_class, 'v1' as model_version,
        cast(timestamp '{RUN_STAMP}' as date) as run_date from z_scores
        union all select order_id, 1.0e0 - p_champion, predicted_class, 'v2', cast(timestamp '{RUN_STAMP}' as date)
        from z_scores""",
    "train_snapshot": "select * from x_train",
    "latest_report": """select cast(grp || '-01' as date) as run_at, '{"period":"' || grp || '","tp":' || tp || ',"fp":'
        || fp || ',"fn":' || fn || ',"tn":' || tn || '}' as report_json from q_cm_month order by grp desc limit 1""",
    "materialize_layer": "select * from m_delay",
    "monitoring_report": f"""select timestamp '{RUN_STAMP}' as run_at, a.n_rows, a.roc_auc, t.precision_at_k,
        q.estimated_total_cost, m.n_months, m.n_alerts, m.n_undefined, cast(m.n_alerts > 0 as int) as any_alert,
        o.overall_status as drift_status,
        (select count(*) from n_shift_psi where psi is null) as n_unknown,
        (select string_agg(category, ',' order by feature) from c_shift_ranked where rank = 1) as first_shifts
        from q_all a, q_top t, q_cost q, overall_shift o, (select count(*) as n_months,
          count(*) filter (where alert) as n_alerts, count(*) filter (where roc_auc is null) as n_undefined
          from q_month) m""",
    # ---- staging
    "stg_orders": "select * from s_orders",
    "stg_order_items": "select * from s_items",
    "stg_order_payments": "select * from s_payments",
    "stg_order_reviews": "select * from s_reviews",
    "stg_customers": "select * from s_customers",
    "stg_sellers": "select * from s_sellers",
    "stg_products": "select * from s_products",
    "stg_geolocation": """select zip_code_prefix, round(latitude, 6) as latitude, round(longitude, 6) as longitude, city,
        state from s_geolocation""",
    "cast_timestamps": """select order_id, order_purchase_timestamp, order_delivered_carrier_date,
        order_delivered_customer_date from raw_orders""",
    # ---- scalar operators
    "delivery_day_metrics": "select order_id, delivery_days, estimated_delivery_days, delay_days from o_delays",
    "late_flag": "select order_id, is_delayed from o_delays",
    "calendar_features": """select order_id, cast(extract(dow from order_purchased_at) as int) as order_day_of_week,
        cast(extract(hour from order_purchased_at) as int) as order_hour,
        cast(extract(month from order_purchased_at) as int) as order_month from s_orders""",
    "product_volume": "select product_id, length_cm * height_cm * width_cm as product_volume_cm3 from s_products",
    "same_state_flag": """select order_id, item_sequence,
        cast(customer_state = nullif(seller_state, 'AS') as int) as customer_seller_same_state
        from s_items left join s_orders using (order_id) left join s_customers using (customer_id)
        left join s_sellers using (seller_id)""",
    "safe_divide": f"select order_id, {ratio('total_freight_value', 'item_count - 1')} as freight_per_extra_item from i_rollup",
    "cents_to_currency": "select order_id, item_sequence, price from s_items",
    "surrogate_key": f"""select customer_id, {key_of('customer_unique_id', "nullif(customer_state, 'AS')")}
        as person_state_key from s_customers""",
    "coerce_features": f"""select product_id, weight_g as product_weight_g,
        coalesce(nullif(product_category_name, ''), '{contract.MISSING_CATEGORY}') as product_category from s_products""",
    "classify_threshold": "select order_id, p_champion, predicted_class from z_scores",
    "psi_status": f"""select order_date,
        {band('nullif(delay_rate, 1.0)', contract.PSI_WARNING, contract.PSI_ALERT)} as status from m_delay""",
    "validate_columns": "select count(*) as n_rows, 'order_hour,seller_state' as missing from x_features",
    "feature_matrix": f"""select * exclude ({', '.join([*contract.IDENTIFIER_COLUMNS, contract.LABEL])}) from x_features""",
    "calendar_months_between": """select order_id, cast((year(order_estimated_delivery_at) - year(order_purchased_at)) * 12
        + month(order_estimated_delivery_at) - month(order_purchased_at) as int) as months from s_orders""",
    # ---- filters
    "valid_orders": "select order_id, order_date, order_status, item_count, total_payment_value from v_valid",
    "delay_eligible": "select order_id, order_date, is_delayed from v_eligible",
    "scored_frame": """select order_id, predicted_probability, predicted_class, order_date, actual_is_delayed from z_bridge
        where actual_is_delayed is not null and order_date is not null""",
    "temporal_split": "select order_id, split from x_labelled",
    "extended_split": f"""select s.split, count(f.order_id) as n_rows
        from (select unnest(['train', 'validation', 'test']) as split) s
        left join f_core f on f.is_delayed is not null and s.split = {split_of('f.order_purchased_at', EXTENDED_END)}
        group by 1""",
    # ---- intermediate results, dimensions, facts
    "payments_aggregated": "select * from o_payments",
    "order_status_normalized": """select order_id, order_status as raw_status, normalized_status, is_delivered, is_canceled
        from o_delays""",
    "latest_review": "select * from o_review",
    "int_orders_enriched": "select * from o_enriched",
    "item_rollup": "select * from i_rollup",
    "primary_line": "select * from i_primary",
    "dim_customers": "select * from d_customers",
    "dim_sellers": "select * from d_sellers",
    "dim_products": "select * from d_products",
    "fact_order_items": "select * from f_items",
    "fact_orders": "select * from f_orders",
    # ---- metrics and features
    "met_daily_gmv": "select * from m_gmv",
    "met_daily_revenue": "select * from m_revenue",
    "met_daily_delay_rate": "select * from m_delay",
    "seller_history": "select * from x_history",
    "order_features": "select * from x_features",
    "fct_predictions": "select * from z_bridge",
    "latest_predictions": "select * from z_bridge order by order_date desc nulls last, order_id limit 10",
    # ---- quality
    "assert_unique": "select order_id, count(*) as n_records from s_payments group by 1 having count(*) > 1",
    "assert_unique_combination": """select product_id, seller_id, count(*) as n_records from s_items group by 1, 2
        having count(*) > 1""",
    "assert_not_null": "select * from ("
    + " union all ".join(
        f"select '{c}' as column_name, count(*) filter (where {c} is null) as n_records from o_enriched"
        for c in ENRICHED_COLUMNS
    )
    + ") t where n_records > 0",
    "assert_accepted_values": f"""select order_status, count(*) as n_records from s_orders
        where order_status not in ({quoted(s for s in contract.ORDER_STATUSES if s != 'unavailable')}) group by 1""",
    "assert_relationships": """select product_id, count(*) as n_records from s_items
        where product_id not in (select product_id from s_products where weight_g is not null) group by 1""",
    "assert_equal_rowcount": """select a.n as left_rows, b.n as right_rows from (select count(*) as n from z_scores) a,
        (select count(*) as n from f_core) b where a.n <> b.n""",
    "assert_no_future_orders": f"""select order_id, order_purchased_at from s_orders
        where order_purchased_at > timestamp '{AS_OF}'""",
    "assert_unit_interval": """select order_id, p as predicted_probability
        from (select order_id, nullif(p_champion * 1.25e0, 0) as p from z_scores) t
        where p is null or p not between 0 and 1""",
    "metric_reconcile_gmv": f"""select m.t as metric_total, f.t as fact_total
        from (select round({amount('gmv + 1')}, 6) as t from m_gmv) m,
        (select round({amount('coalesce(total_payment_value, 0)')}, 6) as t from v_valid) f where m.t <> f.t""",
    "metric_reconcile_revenue": f"""select m.t as metric_total, f.t as fact_total
        from (select round({amount('gmv')}, 6) as t from m_gmv) m,
        (select round({amount('coalesce(total_payment_value, 0)')}, 6) as t from v_valid
          where order_status = 'delivered') f where m.t <> f.t""",
    "leakage_check": f"""select order_id, case when label is null then '{LEAK_REASONS['label_absent']}'
          else '{LEAK_REASONS['label_unexpected']}' end as violation
        from (select o.order_id, case when extract(hour from o.order_purchased_at) = 3 then null
              when extract(hour from o.order_purchased_at) = 5 then 1 else f.is_delayed end as label,
            o.is_delivered = 1 and o.order_delivered_customer_at is not null
              and o.order_estimated_delivery_at is not null as eligible
          from o_delays o join f_core f on f.order_id = o.order_id) t
        where (label is not null) <> eligible
        union all
        select order_id, '{LEAK_REASONS['history_early']}' from (select order_id, row_number() over (
          partition by seller_id order by order_purchased_at, order_id) as place from f_core
          where seller_id is not null) u where place = 1""",
    # ---- model quality
    "class_balance": f"""select split, is_delayed, count(*) as n_rows,
        cast(100 * count(*) as double) / cast(sum(count(*)) over (partition by split) as double) as percent
        from (select is_delayed, {split_of('order_purchased_at')} as split from f_core where is_delayed is not null) t
        group by 1, 2""",
    "confusion_matrix": "select tp, fp, fn, tn from q_cm_all",
    "evaluate_split": """select grp as split, n_rows, roc_auc, "precision", recall, f1, tp, fp, fn, tn from q_split
        where grp <> 'train'""",
    "evaluation_summary": """select n.split, (select count(*) from z_scores z where z.split = n.split) as split_rows, roc_auc,
        "precision", recall, f1, tp, fp, fn, tn
        from (select unnest(['train', 'validation', 'test']) as split) n
        left join q_split q on q.grp = n.split and q.grp <> 'train'""",
    "classification_metrics": 'select grp as split, "precision", recall, f1 from q_split',
    "roc_auc": "select grp as split, auc as roc_auc from q_auc_split",
    "precision_at_k": "select * from q_top",
    "cost_analysis": "select * from q_cost",
    "auc_gate": f"""select auc as roc_auc, cast({MINIMUM_AUC} as double) as minimum_auc,
        cast(coalesce(auc >= {MINIMUM_AUC}, false) as int) as passed from q_auc_split where grp = 'test'""",
    "monthly_confusion": "select grp as period, tp, fp, fn, tn from q_cm_month",
    "monthly_metrics": """select grp as period, n_rows, roc_auc, "precision", recall, f1, cast(alert as int) as roc_auc_alert
        from q_month""",
    "overall_metrics": f"""select n_rows, roc_auc, "precision", recall, f1,
        cast(coalesce(roc_auc < {BASELINE_AUC} - {contract.AUC_ALERT_DELTA}e0, false) as int)
          as roc_auc_below_baseline_alert, q_cost.* from q_all, q_cost""",
    # ---- drift
    "quantile_edges": "select feature, cast(position as int) as position, edge from n_test_edges",
    "histogram_counts": """select feature, cast(bin as int) as bin, cast(baseline_n as bigint) as baseline_n,
        cast(current_n as bigint) as current_n from n_test_histogram""",
    "psi_numeric": "select feature, round(psi, 6) as psi from n_test_psi",
    "numeric_drift": f"""select feature, round(psi, 6) as psi, {band('psi', contract.PSI_WARNING, contract.PSI_ALERT)} as status
        from n_shift_psi""",
    "categorical_drift": "select * from c_shift_worst",
    "categorical_drift_top": f"""select feature, category, baseline_share, current_share, abs_diff, cast(rank as int) as rank
        from c_shift_ranked where rank <= {contract.TOP_SHIFTS}""",
    "drift_overall": """select overall_status, 'test' as side from overall_test
        union all select overall_status, 'shifted' from overall_shift""",
    # ---- model preparation
    "prepare_numeric": " union all ".join(
        f"""select '{f}' as feature, round(median({f}), 6) as median,
        round(avg(coalesce({f}, m)), 6) as mean, round(stddev_pop(coalesce({f}, m)), 6) as scale
        from x_train, (select median({f}) as m from x_train) t"""
        for f in NUMERIC
    ),
    "category_vocabulary": "select * from y_vocabulary",
    "train_logistic": f"""select feature, 1 as optimal from (
        select unnest({[*NUMERIC, '(intercept)']}) as feature
        union all select distinct feature || '=' || label from y_slots) f""",
    "top_coefficients": "select feature, coefficient from y_coefficients order by abs(coefficient) desc, feature limit 25",
    "score_orders": f"""select order_id, round(p, 9) as predicted_probability, cast(p >= {contract.CLASS_THRESHOLD} as int) as predicted_class,
        '{VERSION}' as model_version, timestamp '{RUN_STAMP}' as prediction_timestamp from y_scored""",
    "score_dry_run": f"select count(*) as n_input, count(*) as n_scored, '{VERSION}' as model_version from x_features",
    # ---- retraining
    "baseline_lookup": "select roc_auc_val as baseline_roc_auc, train_snapshot from r_registry",
    "longest_alert_run": "select * from r_runs",
    "trigger_performance": "select * from r_fired where trigger_name = 'performance'",
    "trigger_drift": "select * from r_fired where trigger_name = 'drift'",
    "trigger_calendar": "select * from r_fired where trigger_name = 'calendar'",
    "retrain_decision": """select trigger_name, trigger_name || ' ' || measured || ' >= ' || needed as reason from r_fired
        where fired = 1""",
    "compare_models": "select * from r_compare",
    "promote_registry": "select "
    + ", ".join(
        [
            promoted_or(f"date '{AS_OF}'", "trained_on"),
            promoted_or(f"date '{EXTENDED_END}'", "train_cutoff"),
            promoted_or("r.test_start - 1", "validation_end"),
            "r.test_start",
            promoted_or("'train_v2'", "train_snapshot"),
            *[promoted_or(ext_rows(s), f"{s}_rows") for s in ("train", "validation", "test")],
            *[promoted_or(ext_metric(m), f"{m}_val") for m in ("roc_auc", "precision", "recall", "f1")],
            *[promoted_or(f"c.challenger_{m}", f"{m}_test") for m in ("roc_auc", "precision", "recall", "f1")],
            promoted_or("'v2'", "version"),
        ]
    )
    + " from r_registry r, r_compare c",
}

# Datasets of the quality contract by their definition above.
DATASETS = {
    "stg_orders": "s_orders", "stg_order_items": "s_items", "stg_order_payments": "s_payments",
    "stg_order_reviews": "s_reviews", "stg_customers": "s_customers", "stg_sellers": "s_sellers",
    "stg_products": "s_products", "stg_geolocation": "s_geolocation", "payments_aggregated": "o_payments",
    "int_orders_enriched": "o_enriched", "dim_customers": "d_customers", "dim_sellers": "d_sellers",
    "dim_products": "d_products", "fact_orders": "f_orders", "fact_order_items": "f_items",
    "met_daily_gmv": "m_gmv", "met_daily_revenue": "m_revenue", "met_daily_delay_rate": "m_delay",
    "order_features": "x_features", "fct_predictions": "z_bridge", "order_status_normalized":
    "(select order_id, order_status as raw_status, normalized_status, is_delivered, is_canceled from o_delays)",
}


def quality_answer() -> str:
    rows = []

    def add(check: str, table: str, columns: str, counting: str) -> None:
        rows.append(f"select '{check}' as check_name, '{table}' as table_name, '{columns}' as columns, ({counting}) as n")

    def violations(table: str, condition: str) -> str:
        return f"select count(*) from {DATASETS[table]} t where {condition}"

    for table, columns in NOT_NULL.items():
        for c in columns:
            add("not_null", table, c, violations(table, f"{c} is null"))
    for table, c, values in ACCEPTED:
        add("accepted_values", table, c, violations(table, f"{c} not in ({quoted(values)})"))
    for table, columns in UNIQUE:
        listed = ", ".join(columns)
        add(
            "unique" if len(columns) == 1 else "unique_combination", table, ",".join(columns),
            f"select count(*) from (select {listed} from {DATASETS[table]} t group by {listed} having count(*) > 1) u",
        )
    for table, c, parent, pc in RELATIONSHIPS:
        add(
            "relationships", table, c,
            f"select count(distinct {c}) from {DATASETS[table]} t where {c} not in (select {pc} from {DATASETS[parent]} p)",
        )
    add("not_in_future", "stg_orders", "order_purchased_at", violations("stg_orders", f"order_purchased_at > timestamp '{AS_OF}'"))
    add("unit_interval", "met_daily_delay_rate", "delay_rate", violations("met_daily_delay_rate", "delay_rate not between 0 and 1"))
    add(
        "unit_interval", "fct_predictions", "predicted_probability",
        violations("fct_predictions", "predicted_probability is null or predicted_probability not between 0 and 1"),
    )
    for left, right in (("fact_order_items", "stg_order_items"), ("fct_predictions", "order_features")):
        add(
            "equal_rowcount", left, right,
            f"select case when (select count(*) from {DATASETS[left]}) = (select count(*) from {DATASETS[right]}) then 0 else 1 end",
        )
    for table, column, rows_of in (
        ("met_daily_gmv", "gmv", "v_valid"),
        ("met_daily_revenue", "revenue", "(select * from v_valid where order_status = 'delivered') v"),
    ):
        add(
            "total_matches_fact", table, column,
            f"select case when (select round({amount(column)}, 6) from {DATASETS[table]}) = "
            f"(select round({amount('coalesce(total_payment_value, 0)')}, 6) from {rows_of}) then 0 else 1 end",
        )
    add(
        "no_leakage", "order_features", "order_id",
        """select count(*) from o_delays o join x_features f on f.order_id = o.order_id
        where (f.is_delayed is not null) <> (o.is_delivered = 1 and o.order_delivered_customer_at is not null
          and o.order_estimated_delivery_at is not null)""",
    )
    return (
        "select check_name, table_name, columns, cast(n as bigint) as n_violations, cast(n = 0 as int) as passed from ("
        + " union all ".join(rows)
        + ") s"
    )


def all_queries() -> dict[str, str]:
    definitions = {**RECIPES, **MODELS}
    answers = {**ANSWERS, "quality_suite": quality_answer()}
    out = {}
    for name, answer in answers.items():
        prefix = with_clauses(["_answer"], {**definitions, "_answer": answer})
        out[name] = f"{prefix} select * from _answer"
    return out
