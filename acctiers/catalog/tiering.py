"""Queries for features, scoring, tiers, segments and published marts (sections M to O, R, S)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctiers.catalog.registry import query
from acctiers.catalog.sql import AS_OF, BACKTEST, PARTS, RUN_DATES, expert_weights, score_expression
from acctiers.plans import features as FT
from acctiers.plans import published as P
from acctiers.plans import scoring as SC
from acctiers.plans import tiers as TR
from acctiers.plans.runs import CUSTOMER_INPUTS, ORDER_INPUTS, frames_from_sources
from acctiers.plans.segments import behavioral_segments
from acctiers.plans.warehouse import Warehouse
from acctiers.session import freeze, kept
from acctiers.settings import SCORE_FEATURES, TIERING, merge
from acctiers.sources import testtables as T

NAMES = list(SCORE_FEATURES)
FEATURE_ROUNDS = (
    "monetary_12m:4 recency_days:1 gross_margin_pct revenue_growth active_month_ratio late_payment_rate return_rate "
    "avg_order_value:8 avg_discount tenure_days:1 employee_count:1"
)
SCORE_ROUNDS = " ".join(f"{n}_score" for n in NAMES) + " composite_score:4"
MART_ROUNDS = (
    "composite_score:4 score_percentile:4 monetary_12m:4 avg_order_value:8 recency_days:1 gross_margin_pct revenue_growth "
    "active_month_ratio late_payment_rate return_rate tenure_days:1 lifetime_revenue:4"
)


class Inputs:
    """The three tiering inputs.  Orders carry their categories, so lines are read once, and are stored as in a
    production run: the features, the marts and the dashboards' tables all read them there."""

    def __init__(self, spark, sf):
        self.warehouse = Warehouse.from_test_tables(spark, sf)
        self.warehouse.fct_orders = kept(self.warehouse.fct_orders_with_categories, "fct_orders")
        carried = [c for c in ("categories", "category_bits") if c in self.warehouse.fct_orders.columns]
        self.orders = self.warehouse.fct_orders.select(*ORDER_INPUTS, *carried)
        self.lines = FT.lines_from_orders(self.orders)
        self.customers = self.warehouse.stg_customers.select(*CUSTOMER_INPUTS)

    def features(self, as_of: str = AS_OF) -> DataFrame:
        return FT.build_features(self.orders, self.lines, self.customers, as_of)

    def run(self, as_of=AS_OF, cfg: dict | None = None, segment: bool = False) -> TR.TierRun:
        return TR.score_customers(self.orders, self.lines, self.customers, as_of, cfg, segment)

    def oriented(self) -> DataFrame:
        return SC.prepare(freeze(self.features()), TIERING["features"], TIERING["winsor"])


def feature_query(name: str, columns: str, rounds: str = "") -> None:
    names = columns.split()
    query(name, f"select customer_id, {', '.join(names)} from features_now", rounds)(
        lambda s, d: Inputs(s, d).features().select("customer_id", *names)
    )


# --- M: features -------------------------------------------------------------------------------

feature_query("M1_monetary", "monetary_12m", "monetary_12m:4")
feature_query("M2_frequency", "frequency_12m")
feature_query("M3_recency", "recency_days", "recency_days:1")
feature_query("M4_gross_margin_pct", "gross_margin_pct", "gross_margin_pct")
feature_query("M5_revenue_growth", "revenue_growth", "revenue_growth")
feature_query("M6_category_breadth", "category_breadth")
feature_query("M7_active_month_ratio", "active_month_ratio", "active_month_ratio")
feature_query("M8_late_payment_rate", "late_payment_rate", "late_payment_rate")
feature_query("M9_return_rate", "return_rate", "return_rate")
feature_query("M10_avg_order_value", "avg_order_value", "avg_order_value:8")
feature_query("M11_avg_discount", "avg_discount", "avg_discount")
feature_query("M12_tenure_days", "tenure_days", "tenure_days:1")
feature_query("M13_customer_attributes", "employee_count industry region", "employee_count:1")

_CATALOG = " union all ".join(
    f"""select '{n}' as feature, count({n}) as present, count(*) - count({n}) as missing, avg(cast({n} as double)) as mean,
        min(cast({n} as double)) as low, max(cast({n} as double)) as high from features_now"""
    for n in FT.MODEL_FEATURES
)
query("M14_feature_catalog", _CATALOG, "mean:4 low:4 high:4")(lambda s, d: FT.feature_catalog(Inputs(s, d).features()))
query("M_build_features", "select * from features_now", FEATURE_ROUNDS)(lambda s, d: Inputs(s, d).features())


@query("M15_forward_labels", "select * from labels_past", "future_revenue:4")
def _(spark, sf):
    inputs = Inputs(spark, sf)
    return FT.forward_labels(inputs.orders, inputs.features(BACKTEST), BACKTEST)


@query(
    "M16_build_features_multi",
    " union all ".join(f"select * from features_run{i}" for i in (1, 2, 3)),
    FEATURE_ROUNDS,
)
def _(spark, sf):
    inputs = Inputs(spark, sf)
    return FT.build_features_multi(inputs.orders, inputs.lines, inputs.customers, RUN_DATES)


@query("A14_frames_from_source_tables", "select * from features_now", FEATURE_ROUNDS)
def _(spark, sf):
    orders, lines, customers = frames_from_sources(T.raw_tables(spark, sf))
    return FT.build_features(orders, lines, customers, AS_OF)


# --- N: scoring ------------------------------------------------------------------------------------

query("N1_prepare", "select * from oriented_now", " ".join(NAMES))(lambda s, d: Inputs(s, d).oriented())
query("N2_percentile", "select * from percentile_now", " ".join(NAMES))(
    lambda s, d: SC.normalize(freeze(Inputs(s, d).oriented()), NAMES, "percentile")
)

_MINMAX = ", ".join(
    f"""({n} - min({n}) over ()) / case when max({n}) over () = min({n}) over () then 1.0
        else max({n}) over () - min({n}) over () end as {n}"""
    for n in NAMES
)
PARTS["minmax_now"] = f"select customer_id, as_of_date, {_MINMAX} from oriented_now"
query("N3_minmax", "select * from minmax_now", " ".join(NAMES))(
    lambda s, d: SC.normalize(freeze(Inputs(s, d).oriented()), NAMES, "minmax")
)
query("N4_zscore")(lambda s, d: SC.normalize(freeze(Inputs(s, d).oriented()), NAMES, "zscore"))

PARTS["diversity_now"] = " union all ".join(
    f"""select '{n}' as feature, greatest(1 - (-(sum(({n} + 1e-9) * ln({n} + 1e-9)) / sum({n} + 1e-9) - ln(sum({n} + 1e-9))))
        / ln(count(*)), 0.0) as diversity from minmax_now"""
    for n in NAMES
)
PARTS["entropy_now"] = "select feature, diversity / sum(diversity) over () as weight from diversity_now"


def _weight_rows(spark, weights: dict[str, float]) -> DataFrame:
    return spark.createDataFrame(list(weights.items()), "feature string, weight double")


@query("N5_entropy_weights", "select * from entropy_now", "weight")
def _(spark, sf):
    return _weight_rows(spark, SC.entropy_weights(freeze(Inputs(spark, sf).oriented()), NAMES))


_EXPERT = " union all ".join(f"select '{n}' as feature, cast({w!r} as double) as weight" for n, w in expert_weights().items())


@query(
    "N6_resolve_weights",
    f"""select e.feature, x.weight as expert, e.weight as entropy, (x.weight + e.weight) / 2 as blend
        from entropy_now e join ({_EXPERT}) x on x.feature = e.feature""",
    "expert entropy blend",
)
def _(spark, sf):
    entropy = SC.entropy_weights(freeze(Inputs(spark, sf).oriented()), NAMES)
    expert = SC.expert_weights(TIERING)
    kinds = {m: SC.resolve_weights(m, expert, entropy) for m in ("config", "entropy", "blend")}
    rows = [(n, kinds["config"][n], kinds["entropy"][n], kinds["blend"][n]) for n in NAMES]
    return spark.createDataFrame(rows, "feature string, expert double, entropy double, blend double")


query("N7_composite_score", "select * from scores_now", SCORE_ROUNDS)(
    lambda s, d: SC.composite_score(freeze(Inputs(s, d).features())).scores
)
query(
    "N7_weight_override",
    f"select customer_id, {score_expression(SC.scale_to_one(dict.fromkeys(NAMES, 1.0)))} as composite_score from minmax_now",
    "composite_score:3",
)(
    lambda s, d: SC.composite_score(
        freeze(Inputs(s, d).features()), merge(TIERING, {"normalization": "minmax"}), dict.fromkeys(NAMES, 1.0)
    ).scores.select("customer_id", "composite_score")
)

# --- O: tiers and segments -----------------------------------------------------------------------------

query("O1_assign_tiers", "select customer_id, composite_score, tier from tiers_now", "composite_score:4")(
    lambda s, d: Inputs(s, d).run().tiers.select("customer_id", "composite_score", "tier")
)
query(
    "O2_tier_rank",
    "select tier, tier_rank, count(*) as customers from tiers_now group by tier, tier_rank",
)(
    lambda s, d: Inputs(s, d).run().tiers.groupBy("tier", "tier_rank").agg(F.count(F.lit(1)).alias("customers"))
)
query("O3_score_percentile", "select customer_id, score_percentile from tiers_now", "score_percentile:4")(
    lambda s, d: Inputs(s, d).run().tiers.select("customer_id", "score_percentile")
)


def _normalized(spark, sf) -> DataFrame:
    return freeze(SC.normalize(freeze(Inputs(spark, sf).oriented()), NAMES))


@query("O4_behavioral_segments")
def _(spark, sf):
    return behavioral_segments(_normalized(spark, sf), NAMES, TIERING["segments"]).labels


@query("O5_silhouette_by_k")
def _(spark, sf):
    found = behavioral_segments(_normalized(spark, sf), NAMES, TIERING["segments"])
    return spark.createDataFrame(list(found.by_k.items()), "k int, silhouette double")


@query("O6_segment_profiles")
def _(spark, sf):
    return behavioral_segments(_normalized(spark, sf), NAMES, TIERING["segments"]).profiles


_MEAN = "(" + " + ".join(NAMES) + f") / {len(NAMES)}"


@query(
    "O7_segment_names",
    f"""select region, segment, customers from (
          select *, case when turn = 1 then name else concat(name, ' ', turn) end as segment from (
            select *, row_number() over (partition by name order by value desc, region) as turn from (
              select *, case when value >= 0.65 then 'Champions'
                             when revenue_growth >= 0.6 and value >= 0.45 then 'Rising Stars'
                             when recency_days < 0.35 or active_month_ratio < 0.3 then 'At Risk'
                             when frequency_12m >= 0.55 and monetary_12m < 0.5 then 'Frequent Small Buyers'
                             when gross_margin_pct >= 0.6 then 'Profitable Niche'
                             when late_payment_rate < 0.35 or return_rate < 0.35 then 'Credit / Service Risk'
                             else 'Steady Core' end as name from (
                select *, {_MEAN} as value from (
                  select f.region, count(*) as customers, {', '.join(f'avg(p.{n}) as {n}' for n in NAMES)}
                  from percentile_now p join features_now f on f.customer_id = p.customer_id group by f.region)))))""",
)
def _(spark, sf):
    from acctiers.plans.segments import segment_profiles

    features = freeze(Inputs(spark, sf).features())
    oriented = freeze(SC.prepare(features, TIERING["features"], TIERING["winsor"]))
    normalized = SC.normalize(oriented, NAMES).join(features.select("customer_id", "region"), "customer_id")
    named = segment_profiles(normalized.withColumnRenamed("region", "cluster"), NAMES)
    return named.select(F.col("cluster_id").alias("region"), "segment", "customers")


query("O8_score_customers", "select * from scored_now", f"{FEATURE_ROUNDS} {SCORE_ROUNDS} score_percentile:4")(
    lambda s, d: Inputs(s, d).run().tiers
)

# --- F, D, R: history and published marts -----------------------------------------------------------------

PARTS["history"] = " union all ".join(
    f"select customer_id, as_of_date, composite_score, tier, tier_rank from scored_run{i}" for i in (1, 2, 3)
)
PARTS["previous"] = """
select customer_id, as_of_date, tier, tier_rank,
       lag(tier) over (partition by customer_id order by as_of_date) as previous_tier,
       lag(tier_rank) over (partition by customer_id order by as_of_date) as previous_tier_rank,
       lag(as_of_date) over (partition by customer_id order by as_of_date) as previous_as_of_date
from history"""
_MOVE = """case when previous_tier is null then 'New' when tier_rank < previous_tier_rank then 'Upgraded'
                when tier_rank > previous_tier_rank then 'Downgraded' else 'Stable' end"""
PARTS["mart_customer_tiers"] = f"""
select t.customer_id, c.business_name, c.industry, c.region, c.company_size_band, c.account_manager, t.as_of_date,
       t.composite_score, t.score_percentile, t.tier, t.tier_rank, h.previous_tier,
       {_MOVE.replace('tier_rank <', 't.tier_rank <').replace('tier_rank >', 't.tier_rank >')} as tier_movement,
       t.monetary_12m, t.frequency_12m, t.avg_order_value, t.recency_days, t.gross_margin_pct, t.revenue_growth,
       t.category_breadth, t.active_month_ratio, t.late_payment_rate, t.return_rate, t.tenure_days,
       c.lifetime_revenue, c.is_active
from scored_now t left join dim_customers c on c.customer_id = t.customer_id
left join previous h on h.customer_id = t.customer_id and h.as_of_date = t.as_of_date"""
PARTS["mart_tier_movement"] = f"""
select as_of_date, previous_as_of_date, coalesce(previous_tier, 'New') as from_tier, tier as to_tier,
       {_MOVE} as movement, count(*) as customers
from previous group by all"""
PARTS["mart_tier_summary"] = """
select tier, tier_rank, count(*) as customers, avg(composite_score) as avg_composite_score,
       min(composite_score) as min_composite_score, sum(monetary_12m) as revenue_12m, avg(monetary_12m) as avg_revenue_12m,
       avg(frequency_12m) as avg_orders_12m, avg(gross_margin_pct) as avg_gross_margin_pct,
       avg(revenue_growth) as avg_revenue_growth, avg(late_payment_rate) as avg_late_payment_rate,
       avg(recency_days) as avg_recency_days,
       count(*) filter (where tier_movement = 'Upgraded') as upgraded,
       count(*) filter (where tier_movement = 'Downgraded') as downgraded,
       count(*) / cast((select count(*) from mart_customer_tiers) as double) as customer_share,
       sum(monetary_12m) / (select sum(monetary_12m) from mart_customer_tiers) as revenue_share
from mart_customer_tiers group by tier, tier_rank"""
SUMMARY_ROUNDS = (
    "avg_composite_score min_composite_score:4 revenue_12m:4 avg_revenue_12m:3 avg_orders_12m avg_gross_margin_pct avg_revenue_growth "
    "avg_late_payment_rate avg_recency_days:4 customer_share revenue_share"
)


class Scored(Inputs):
    """Three scoring runs as tier history, the last one as the current tiers."""

    def __init__(self, spark, sf):
        super().__init__(spark, sf)
        kept = ["customer_id", "as_of_date", "composite_score", "tier", "tier_rank"]
        run = self.run(RUN_DATES)
        self.history = run.tiers.select(*kept)
        self.current = run.at(RUN_DATES[-1])
        self.tiers = self.current.tiers
        self.mart = P.mart_customer_tiers(self.tiers, self.warehouse.dim_customers, self.history)

    def segmented(self) -> DataFrame:
        """The current tiers with the segment of each customer."""
        found = behavioral_segments(self.current.normalized(), list(TIERING["features"]), TIERING["segments"])
        return self.tiers.join(found.labels, "customer_id")


query("F3_previous_tier", "select customer_id, as_of_date, tier, previous_tier, previous_tier_rank from previous")(
    lambda s, d: P.previous_runs(Scored(s, d).history).select(
        "customer_id", "as_of_date", "tier", "previous_tier", "previous_tier_rank"
    )
)
query("F4_previous_run", "select * from previous")(lambda s, d: P.previous_runs(Scored(s, d).history))
query("R1_mart_customer_tiers", "select * from mart_customer_tiers", MART_ROUNDS)(lambda s, d: Scored(s, d).mart)
query("D5_tiers_with_history", "select customer_id, as_of_date, tier, previous_tier, tier_movement, is_active from mart_customer_tiers")(
    lambda s, d: Scored(s, d).mart.select("customer_id", "as_of_date", "tier", "previous_tier", "tier_movement", "is_active")
)
query("R2_mart_tier_summary", "select * from mart_tier_summary", SUMMARY_ROUNDS)(
    lambda s, d: P.mart_tier_summary(Scored(s, d).mart)
)
query("E5_tier_kpis", "select tier, customers, avg_orders_12m, upgraded, downgraded from mart_tier_summary", "avg_orders_12m")(
    lambda s, d: P.mart_tier_summary(Scored(s, d).mart).select("tier", "customers", "avg_orders_12m", "upgraded", "downgraded")
)
query("D6_tier_shares", "select tier, customer_share, revenue_share from mart_tier_summary", "customer_share revenue_share")(
    lambda s, d: P.mart_tier_summary(Scored(s, d).mart).select("tier", "customer_share", "revenue_share")
)
query("R3_mart_tier_movement", "select * from mart_tier_movement")(
    lambda s, d: P.mart_tier_movement(Scored(s, d).history)
)
query(
    "E6_movement_counts",
    "select as_of_date, movement, cast(sum(customers) as bigint) as customers from mart_tier_movement group by 1, 2",
)(lambda s, d: P.movement_trend(P.mart_tier_movement(Scored(s, d).history)))

# --- S: dashboard datasets -------------------------------------------------------------------------------------


@query(
    "S1_pareto_curve",
    """select customer_id, tier, monetary_12m, row_number() over (order by monetary_12m desc, customer_id) as customer_rank,
              sum(monetary_12m) over (order by monetary_12m desc, customer_id rows unbounded preceding) as cumulative_revenue,
              sum(monetary_12m) over (order by monetary_12m desc, customer_id rows unbounded preceding)
                / sum(monetary_12m) over () as cumulative_share
       from scored_now""",
    "monetary_12m:4 cumulative_revenue:4 cumulative_share",
)
def _(spark, sf):
    return P.pareto_curve(Inputs(spark, sf).run().tiers)


query(
    "S2_tier_pyramid",
    "select tier, tier_rank, customers, customer_share, revenue_12m, revenue_share from mart_tier_summary",
    "customer_share revenue_12m:4 revenue_share",
)(lambda s, d: P.tier_pyramid(Scored(s, d).mart))
query(
    "S2_kpi_tiles",
    """select count(*) filter (where is_active) as active_customers, sum(monetary_12m) as revenue_12m,
              sum(monetary_12m) filter (where tier in ('Platinum', 'Gold')) / sum(monetary_12m) as top_two_tier_share
       from mart_customer_tiers""",
    "revenue_12m:4 top_two_tier_share",
)(lambda s, d: P.kpi_tiles(Scored(s, d).mart))
query(
    "S3_movement_trend",
    "select as_of_date, movement, cast(sum(customers) as bigint) as customers from mart_tier_movement group by 1, 2",
)(lambda s, d: P.movement_trend(P.mart_tier_movement(Scored(s, d).history)))


@query(
    "S4_monthly_trend",
    """with m as (select month, sum(net_revenue) as net_revenue, sum(gross_margin) as gross_margin from fct_customer_monthly group by month)
       select a.month, a.net_revenue, a.gross_margin, b.net_revenue as net_revenue_year_ago,
              case when b.net_revenue <> 0 then (a.net_revenue - b.net_revenue) / b.net_revenue end as yoy_growth
       from m a left join m b on a.month = b.month + interval 12 month""",
    "net_revenue:4 gross_margin:4 net_revenue_year_ago:4 yoy_growth",
)
def _(spark, sf):
    return P.monthly_trend(Warehouse.from_test_tables(spark, sf).fct_customer_monthly)


@query(
    "S5_revenue_cube",
    """select c.region, c.industry, o.channel, sum(o.recognized_revenue) as revenue, count(*) as orders
       from fct_orders o join stg_customers c on c.customer_id = o.customer_id group by cube (c.region, c.industry, o.channel)""",
    "revenue:4",
)
def _(spark, sf):
    w = Warehouse.from_test_tables(spark, sf)
    return P.revenue_cube(w.fct_orders, w.stg_customers)


@query(
    "S6_payment_by_tier",
    """select t.tier, t.tier_rank, count(*) as paid_orders,
              count(*) filter (where o.is_late_payment) / cast(count(*) as double) as late_payment_rate,
              avg(o.days_to_pay) as avg_days_to_pay
       from fct_orders o join scored_now t on t.customer_id = o.customer_id where o.is_paid group by t.tier, t.tier_rank""",
    "late_payment_rate avg_days_to_pay",
)
def _(spark, sf):
    inputs = Inputs(spark, sf)
    return P.payment_by_tier(inputs.warehouse.fct_orders, inputs.run().tiers)


@query(
    "S8_prep_flow",
    f"""with q as (
          select customer_id, {', '.join(
              f"sum(net_revenue) filter (where date_trunc('quarter', month) = date '{q.isoformat()}') as revenue_{q.year}_q{(q.month + 2) // 3}"
              for q in P.quarters_until(date.fromisoformat(AS_OF), 4))}
          from fct_customer_monthly where month >= date '{P.quarters_until(date.fromisoformat(AS_OF), 4)[0].isoformat()}' group by customer_id)
        select m.*, rank() over (order by monetary_12m desc) as revenue_rank,
               rank() over (order by monetary_12m desc) <= count(*) over () * 0.2 as is_top_20,
               coalesce(previous_tier <> tier, false) as tier_changed, q.* exclude (customer_id)
        from mart_customer_tiers m left join q on q.customer_id = m.customer_id""",
    MART_ROUNDS + " " + " ".join(f"revenue_{q.year}_q{(q.month + 2) // 3}:4" for q in P.quarters_until(date.fromisoformat(AS_OF), 4)),
)
def _(spark, sf):
    scored = Scored(spark, sf)
    return P.prep_flow(freeze(scored.mart), scored.warehouse.fct_customer_monthly, None, date.fromisoformat(AS_OF))


