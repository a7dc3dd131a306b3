"""SQL used to check the queries in DuckDB: named parts, joined into one WITH chain on demand."""

from __future__ import annotations

import re

from acctiers.settings import TIERING

PARTS: dict[str, str] = {}

_CENTS = "cast(cast(cast(floor({}) as bigint) as decimal(18,0)) * cast('0.01' as decimal(3,2)) as decimal(28,6))"

PARTS["raw_customers"] = """
select c_custkey as customer_id, c_name as business_name, c_mktsegment as industry, r_name as region,
       case when c_acctbal < -500 then null else cast(floor(abs(c_acctbal) / 10) as bigint) + 1 end as employee_count,
       date '1993-01-01' + cast((c_custkey * 37) % 900 as integer) as signup_date,
       concat('AM-', lpad(cast(c_custkey % 15 + 1 as varchar), 2, '0')) as account_manager,
       timestamp '2001-07-30 00:00:00' as updated_at
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""

PARTS["raw_products"] = f"""
select p_partkey as product_id, p_name as product_name, p_type as category,
       {_CENTS.format('p_retailprice * (60 + p_size % 30)')} as unit_cost,
       cast(p_retailprice as decimal(28,6)) as list_price,
       timestamp '2001-07-30 00:00:00' as updated_at
from part"""

PARTS["raw_orders_typed"] = """
select o_orderkey as order_id, o_custkey as customer_id, cast(o_orderdate as date) as order_date,
       case when o_orderstatus in ('F', 'O') then 'completed'
            when o_orderkey % 2 = 0 then 'cancelled' else 'returned' end as status,
       o_orderpriority as channel, cast(o_orderkey % 11 as double) / 100 as discount_pct,
       cast(case o_orderkey % 4 when 0 then 15 when 1 then 30 when 2 then 45 else 60 end as bigint) as payment_terms_days
from orders"""

PARTS["raw_orders_paid"] = """
select *, case when status = 'completed' and order_id % 9 <> 0
               then order_date + cast(greatest(payment_terms_days + (order_id * 7) % 40 - 20, 0) as integer) end as paid_date
from raw_orders_typed"""

PARTS["raw_orders"] = """
select *, cast(coalesce(paid_date, order_date) as timestamp) as updated_at from raw_orders_paid"""

PARTS["raw_order_items"] = f"""
select l_orderkey * 10 + l_linenumber as order_item_id, l_orderkey as order_id, l_partkey as product_id,
       cast(l_quantity as bigint) as quantity, {_CENTS.format('l_extendedprice * 100 / l_quantity')} as unit_price,
       l_shipdate as updated_at
from lineitem"""


def _newest(relation: str, key: str, order: str) -> str:
    return f"(select * from {relation} qualify row_number() over (partition by {key} order by {order}) = 1)"


PARTS["stg_customers"] = f"""
select customer_id, trim(business_name) as business_name, industry, region, employee_count,
       case when employee_count is null then 'Unknown' when employee_count < 50 then 'Small (<50)'
            when employee_count < 250 then 'Mid-market (50-249)' else 'Enterprise (250+)' end as company_size_band,
       signup_date, account_manager, updated_at
from {_newest('raw_customers', 'customer_id', 'updated_at desc, business_name desc, region desc')}"""

PARTS["stg_products"] = f"""
select product_id, product_name, category, unit_cost, list_price,
       case when list_price <> 0 then cast(list_price - unit_cost as double) / cast(list_price as double) end as list_margin_pct,
       updated_at
from {_newest('raw_products', 'product_id', 'updated_at desc, list_price desc, unit_cost desc')}"""

PARTS["stg_orders_typed"] = f"""
select order_id, customer_id, order_date, lower(status) as status, channel, discount_pct, payment_terms_days,
       order_date + cast(payment_terms_days as integer) as due_date, paid_date, updated_at
from {_newest('raw_orders', 'order_id', 'updated_at desc, status desc, customer_id desc')}"""

PARTS["stg_orders"] = """
select *, cast(date_trunc('month', order_date) as date) as order_month, paid_date is not null as is_paid,
       date_diff('day', order_date, paid_date) as days_to_pay, paid_date > due_date as is_late_payment
from stg_orders_typed"""

PARTS["stg_order_items"] = f"""
select order_item_id, order_id, product_id, quantity, unit_price,
       cast(quantity * unit_price as decimal(38,6)) as line_amount, updated_at
from {_newest('raw_order_items', 'order_item_id', 'updated_at desc, product_id desc, unit_price desc, quantity desc')}"""

PARTS["int_order_lines"] = """
select i.order_item_id, i.order_id, o.customer_id, o.order_date, o.order_month, o.status, i.product_id, p.category,
       i.quantity, i.unit_price, i.line_amount as gross_revenue,
       cast(i.line_amount as double) * (1 - o.discount_pct) as net_revenue,
       cast(i.quantity * p.unit_cost as decimal(38,6)) as cost,
       cast(i.line_amount as double) * (1 - o.discount_pct) - cast(i.quantity * p.unit_cost as double) as gross_margin
from stg_order_items i join stg_orders o on o.order_id = i.order_id join stg_products p on p.product_id = i.product_id"""

PARTS["int_order_totals"] = """
select order_id, count(*) as line_count, count(distinct category) as category_count,
       cast(sum(quantity) as bigint) as units, sum(gross_revenue) as gross_revenue, sum(net_revenue) as net_revenue,
       sum(cost) as cost, sum(gross_margin) as gross_margin
from int_order_lines group by order_id"""

PARTS["fct_orders"] = """
select o.order_id, o.customer_id, o.order_date, o.order_month, o.status, o.channel, o.discount_pct,
       o.payment_terms_days, o.due_date, o.paid_date, o.is_paid, o.days_to_pay, o.is_late_payment,
       t.line_count, t.category_count, t.units, t.gross_revenue, t.net_revenue, t.cost, t.gross_margin,
       case when t.net_revenue <> 0 then t.gross_margin / t.net_revenue end as gross_margin_pct,
       case when o.status in ('completed') then t.net_revenue else 0 end as recognized_revenue,
       case when o.status in ('completed') then t.gross_margin else 0 end as recognized_margin,
       o.updated_at
from stg_orders o join int_order_totals t on t.order_id = o.order_id"""

PARTS["fct_customer_monthly"] = """
select customer_id, order_month as month, count(*) as orders,
       count(*) filter (where status in ('completed')) as completed_orders,
       sum(recognized_revenue) as net_revenue, sum(recognized_margin) as gross_margin,
       case when round(sum(recognized_revenue), 4) <> 0 then sum(recognized_margin) / sum(recognized_revenue) end as gross_margin_pct
from fct_orders group by customer_id, order_month"""

PARTS["order_stats"] = """
select customer_id, min(order_date) as first_order_date,
       max(order_date) filter (where status in ('completed')) as last_order_date,
       count(*) filter (where status in ('completed')) as lifetime_orders,
       sum(recognized_revenue) as lifetime_revenue, sum(recognized_margin) as lifetime_margin
from fct_orders group by customer_id"""

PARTS["dim_customers"] = """
select c.customer_id, c.business_name, c.industry, c.region, c.employee_count, c.company_size_band, c.account_manager,
       c.signup_date, s.first_order_date, s.last_order_date, coalesce(s.lifetime_orders, 0) as lifetime_orders,
       coalesce(s.lifetime_revenue, 0) as lifetime_revenue, coalesce(s.lifetime_margin, 0) as lifetime_margin,
       date_diff('day', s.last_order_date, (select max(order_date) from fct_orders)) as days_since_last_order,
       coalesce(s.last_order_date > (select max(order_date) from fct_orders) - 90, false) as is_active
from stg_customers c left join order_stats s on s.customer_id = c.customer_id"""

PARTS["dim_products"] = """
select p.product_id, p.product_name, p.category, p.unit_cost, p.list_price, p.list_margin_pct,
       cast(coalesce(sum(l.quantity) filter (where l.status in ('completed')), 0) as bigint) as units_sold,
       coalesce(sum(l.net_revenue) filter (where l.status in ('completed')), 0) as net_revenue
from stg_products p left join int_order_lines l on l.product_id = p.product_id
group by all"""


# --- tiering at one date --------------------------------------------------------------------


def _d(day: str) -> str:
    return f"date '{day}'"


def features_sql(as_of: str, lookback: int = 365, min_orders: int = 1) -> str:
    half = lookback // 2
    a = _d(as_of)
    paid = f"(paid_date is not null and paid_date <= {a})"
    due = f"(order_date + cast(payment_terms_days as integer) < {a})"
    return f"""
select w.customer_id, w.monetary_12m, w.frequency_12m, cast({a} - w.last_day as double) as recency_days,
       case when w.monetary_12m > 0 then w.margin / w.monetary_12m else 0.0 end as gross_margin_pct,
       case when w.h1 + w.h2 > 0 then (w.h2 - w.h1) / (w.h1 + w.h2) else 0.0 end as revenue_growth,
       coalesce(b.category_breadth, 0) as category_breadth,
       cast(w.months as double) / cast({max(lookback / 30.4, 1.0)!r} as double) as active_month_ratio,
       w.late_payment_rate,
       cast(w.returned as double) / cast(w.frequency_12m + w.returned as double) as return_rate,
       w.monetary_12m / w.frequency_12m as avg_order_value, w.avg_discount,
       cast(greatest({a} - c.signup_date, 0) as double) as tenure_days,
       cast(c.employee_count as double) as employee_count, c.industry, c.region, {a} as as_of_date
from (
  select customer_id,
         round(coalesce(sum(net_revenue) filter (where status = 'completed'), 0.0), 4) as monetary_12m,
         count(*) filter (where status = 'completed') as frequency_12m,
         round(coalesce(sum(gross_margin) filter (where status = 'completed'), 0.0), 4) as margin,
         avg(discount_pct) filter (where status = 'completed') as avg_discount,
         count(distinct order_month) filter (where status = 'completed') as months,
         round(coalesce(sum(net_revenue) filter (where status = 'completed' and order_date - ({a} - {lookback}) <= {half}), 0.0), 4) as h1,
         round(coalesce(sum(net_revenue) filter (where status = 'completed' and order_date - ({a} - {lookback}) > {half}), 0.0), 4) as h2,
         max(order_date) filter (where status = 'completed') as last_day,
         count(*) filter (where status = 'returned') as returned,
         avg(cast(case when {paid} then paid_date > order_date + cast(payment_terms_days as integer) else {due} end as integer))
           filter (where status = 'completed' and ({paid} or {due})) as late_payment_rate
  from fct_orders where order_date > {a} - {lookback} and order_date <= {a}
  group by customer_id
) w
left join (
  select customer_id, count(distinct category) as category_breadth from int_order_lines
  where order_date > {a} - {lookback} and order_date <= {a} and status = 'completed' group by customer_id
) b on b.customer_id = w.customer_id
left join stg_customers c on c.customer_id = w.customer_id
where w.frequency_12m >= {min_orders}"""


def labels_sql(customers: str, as_of: str, horizon: int = 180, quantile: float = 0.8) -> str:
    a = _d(as_of)
    return f"""
select customer_id, future_revenue, future_orders, cast(future_orders = 0 as bigint) as churned,
       cast(future_revenue > (quantile_cont(future_revenue, {quantile}) over ()) as bigint) as high_value
from (
  select k.customer_id, coalesce(round(sum(o.net_revenue), 4), 0.0) as future_revenue, count(o.order_id) as future_orders
  from {customers} k left join fct_orders o
    on o.customer_id = k.customer_id and o.order_date > {a} and o.order_date <= {a} + {horizon} and o.status = 'completed'
  group by k.customer_id
)"""


def filled_sql(features: str, cfg: dict | None = None) -> str:
    cols = []
    for name, spec in (cfg or TIERING)["features"].items():
        filled = f"coalesce(cast({name} as double), (select median(cast({name} as double)) from {features}), 0.0)"
        cols.append(f"ln(1 + greatest({filled}, 0.0)) as {name}" if spec["transform"] == "log1p" else f"{filled} as {name}")
    return f"select customer_id, as_of_date, {', '.join(cols)} from {features}"


def oriented_sql(filled: str, cfg: dict | None = None) -> str:
    cfg = cfg or TIERING
    low, high = cfg["winsor"]
    cols = []
    for name, spec in cfg["features"].items():
        lo = f"(select quantile_cont({name}, {low}) from {filled})"
        hi = f"(select quantile_cont({name}, {high}) from {filled})"
        cols.append(f"least(greatest({name}, {lo}), {hi}) * {spec['direction']}.0 + 0.0 as {name}")
    return f"select customer_id, as_of_date, {', '.join(cols)} from {filled}"


def average_rank_sql(column: str, by: str = "") -> str:
    """Average rank of a column as an expression over its relation."""
    part = f"partition by {by} " if by else ""
    peers = f"partition by {by}, {column}" if by else f"partition by {column}"
    return f"(rank() over ({part}order by {column}) + (count(*) over ({peers}) - 1) / 2.0)"


def percentile_sql(oriented: str, cfg: dict | None = None) -> str:
    cols = [f"{average_rank_sql(n)} / count(*) over () as {n}" for n in (cfg or TIERING)["features"]]
    return f"select customer_id, as_of_date, {', '.join(cols)} from {oriented}"


def score_expression(weights: dict[str, float], prefix: str = "") -> str:
    total = " + ".join(f"{prefix}{n} * cast({w!r} as double)" for n, w in weights.items())
    return f"round(least(greatest(({total}) * 100, 0.0), 100.0), 4)"


def expert_weights(cfg: dict | None = None) -> dict[str, float]:
    spec = (cfg or TIERING)["features"]
    total = sum(s["weight"] for s in spec.values())
    return {n: s["weight"] / total for n, s in spec.items()}


def score_sql(normalized: str, cfg: dict | None = None) -> str:
    names = list((cfg or TIERING)["features"])
    scores = ", ".join(f"{n} as {n}_score" for n in names)
    return f"select customer_id, as_of_date, {scores}, {score_expression(expert_weights(cfg))} as composite_score from {normalized}"


def tier_case_sql(cfg: dict | None = None) -> str:
    """Tier name from ``share``, the place from the top over the number of customers."""
    tiers = (cfg or TIERING)["tiers"]
    whole, reached, arms = sum(s for _, s in tiers), 0.0, []
    for name, share in tiers[:-1]:
        reached += share / whole
        arms.append(f"when share - 1e-12 <= cast({reached!r} as double) then '{name}'")
    return f"case {' '.join(arms)} else '{tiers[-1][0]}' end"


def tiers_sql(scores: str, cfg: dict | None = None) -> str:
    ranks = [f"when '{name}' then {position}" for position, (name, _) in enumerate((cfg or TIERING)["tiers"], start=1)]
    return f"""
select * exclude (share), cast(case tier {' '.join(ranks)} end as bigint) as tier_rank from (
  select *, {tier_case_sql(cfg)} as tier from (
    select *, row_number() over (order by composite_score desc, customer_id) / cast(count(*) over () as double) as share,
           round({average_rank_sql('composite_score')} / count(*) over (), 4) as score_percentile
    from {scores}))"""


def add_tiering(tag: str, as_of: str, lookback: int = 365) -> None:
    """Register ``features_<tag>`` .. ``tiers_<tag>`` for one as-of date."""
    PARTS[f"features_{tag}"] = features_sql(as_of, lookback)
    PARTS[f"filled_{tag}"] = filled_sql(f"features_{tag}")
    PARTS[f"oriented_{tag}"] = oriented_sql(f"filled_{tag}")
    PARTS[f"percentile_{tag}"] = percentile_sql(f"oriented_{tag}")
    PARTS[f"scores_{tag}"] = score_sql(f"percentile_{tag}")
    PARTS[f"tiers_{tag}"] = tiers_sql(f"scores_{tag}")
    PARTS[f"scored_{tag}"] = (
        f"select f.*, t.* exclude (customer_id, as_of_date) from features_{tag} f join tiers_{tag} t on t.customer_id = f.customer_id"
    )


AS_OF = "2001-08-01"
BACKTEST = "2001-02-02"  # 180 days earlier
RUN_DATES = ("2001-02-01", "2001-05-01", "2001-08-01")

add_tiering("now", AS_OF)
add_tiering("past", BACKTEST)
for _i, _day in enumerate(RUN_DATES, start=1):
    add_tiering(f"run{_i}", _day)
PARTS["labels_past"] = labels_sql("features_past", BACKTEST)
PARTS["judged"] = """
select s.*, l.* exclude (customer_id) from scored_past s join labels_past l on l.customer_id = s.customer_id"""


def _needs(text: str) -> set[str]:
    return {w for w in set(re.findall(r"[a-z_][a-z0-9_]*", text)) if w in PARTS}


def with_parts(final: str) -> str:
    """``final`` preceded by every part it needs, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for need in sorted(_needs(PARTS[name]) - {name}):
            visit(need)
        ordered.append(name)

    for need in sorted(_needs(final)):
        visit(need)
    if not ordered:
        return final
    # parts are read several times; computing each once keeps the check quick
    ctes = ",\n".join(f"{n} as materialized ({PARTS[n].strip()})" for n in ordered)
    return f"with {ctes}\n{final}"
