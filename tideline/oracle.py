"""The registered queries in SQL that DuckDB runs on the same tables."""

from __future__ import annotations

from tideline.sources.passengers import PASSENGER_SQL

# ---- orders -------------------------------------------------------------------------

REVENUE = """
rev as (
 select l_orderkey,
  sum(cast(l_extendedprice as decimal(15,2)) * (1 - cast(l_discount as decimal(15,2)))) as order_revenue
 from lineitem group by l_orderkey)"""

ENRICHED = REVENUE + """,
enriched as (
 select o_orderkey as orderkey, o_custkey as custkey, o_orderstatus as orderstatus,
  o_totalprice as totalprice, o_orderdate as orderdate, o_orderpriority as orderpriority,
  cast(null as varchar) as clerk, cast(null as integer) as shippriority, order_revenue
 from orders left join rev on o_orderkey = l_orderkey)"""

FACT = ENRICHED + """,
fact as (
 select orderkey, custkey, orderstatus, totalprice, orderdate, orderpriority, clerk, shippriority,
  cast(order_revenue as double) as order_revenue,
  row_number() over (partition by custkey order by orderdate desc nulls last, orderkey desc nulls last) as rn_latest,
  dense_rank() over (partition by custkey order by order_revenue desc nulls last) as revenue_rank,
  cast(sum(order_revenue) over (partition by custkey order by orderdate
   range between interval 30 days preceding and current row) as double) as rolling_30d_revenue
 from enriched)"""

TOTALS = """
 select custkey, count(distinct orderkey) as order_cnt,
  cast(sum(cast(order_revenue as decimal(28,4))) as double) as lifetime_revenue,
  max(orderdate) as last_order_date
 from {fact} group by custkey"""

SAMPLE = """,
sample as (select * from enriched order by md5('42:' || orderkey), orderkey limit 5000)"""


def feed(name: str, salt: str, source: str = "sample") -> str:
    return f""",
{name}_drawn as (
 select *, cast('0x' || substring(md5('{salt}:' || orderkey), 1, 13) as bigint) as seq from {source}),
{name}_ops as (
 select *, case when seq / 4503599627370496.0::double < 0.3 then 'I'
  when seq / 4503599627370496.0::double < 0.6 then 'D' else 'U' end as op from {name}_drawn),
{name} as (
 select case when op = 'I' then orderkey + 10000000 else orderkey end as orderkey, custkey, orderstatus,
  totalprice, orderdate,
  case when op = 'U' then concat_ws('-', orderpriority, 'upd') else orderpriority end as orderpriority,
  clerk, shippriority, cast(order_revenue as double) as order_revenue, op, seq
 from {name}_ops)"""


FEED = FACT + SAMPLE + feed("feed", "42b")

STAGED = FEED + """,
staged as (
 select orderkey, custkey, substring(orderstatus, 1, 10) as orderstatus, totalprice, orderdate,
  substring(orderpriority, 1, 15) as orderpriority, substring(clerk, 1, 15) as clerk, shippriority,
  order_revenue, op, cast(0 as bigint) as rn_latest, cast(0 as bigint) as revenue_rank,
  cast(0 as double) as rolling_30d_revenue
 from feed)"""

FACT_COLUMNS = (
    "orderkey",
    "custkey",
    "orderstatus",
    "totalprice",
    "orderdate",
    "orderpriority",
    "clerk",
    "shippriority",
    "order_revenue",
    "rn_latest",
    "revenue_rank",
    "rolling_30d_revenue",
)

MERGED = STAGED + f""",
merged as (
 select {", ".join(
     f"case when s.op is not distinct from 'U' and t.orderkey is not null then s.{c} "
     f"when t.orderkey is null then s.{c} else t.{c} end as {c}" for c in FACT_COLUMNS
 )}
 from fact t full outer join staged s on t.orderkey = s.orderkey
 where (t.orderkey is not null and not (s.op is not distinct from 'D'))
  or (t.orderkey is null and s.op = 'I'))"""

# ---- passengers ---------------------------------------------------------------------

PASSENGERS = f"p as ({PASSENGER_SQL.format(customer='customer')})"

FEATURES = PASSENGERS + """,
f1 as (
 select *, sibsp + parch + 1 as family_size,
  case when sibsp + parch + 1 > 4 then 1 else 0 end as is_large_family,
  case when alone = 'TRUE' then 1 else 0 end as is_solo,
  fare / (sibsp + parch + 1) as fare_per_family_member,
  case when fare < 10 then 'low' when fare < 30 then 'medium' when fare < 100 then 'high' else 'premium' end as fare_bucket,
  case when age < 12 then 'child' when age < 18 then 'teen' when age < 60 then 'adult' else 'senior' end as age_bucket
 from p),
f as (
 select *, fare_bucket = 'premium' and is_solo = 1 as high_fare_solo,
  pclass = 1 and age_bucket = 'child' as first_class_child
 from f1)"""

FARE_RANKS = """
 rank() over (partition by pclass order by fare nulls first) as fare_rank_by_class,
 percent_rank() over (partition by pclass order by fare nulls first) as fare_percentile_by_class"""
AGE_RANK = " dense_rank() over (partition by sex, pclass order by age nulls first) as age_rank_by_sex_class"
FARE_CUMSUM = """
 sum(fare) over (partition by embarked order by fare nulls first, passenger_id
  rows between unbounded preceding and current row) as fare_cumsum_by_embark"""
CENTS = """
 cast(sum(cast(round(fare + (passenger_id % 100) / 100::double, 2) as decimal(18,2))) over (partition by embarked
  order by round(fare + (passenger_id % 100) / 100::double, 2) nulls first, passenger_id
  rows between unbounded preceding and current row) as double) as fare_cumsum_by_embark"""
AGE_MOVING_AVG = """
 avg(age) over (partition by pclass order by fare nulls first, passenger_id
  rows between 1 preceding and 1 following) as age_moving_avg_3"""
FARE_NEIGHBOURS = """
 lag(fare, 1) over (partition by pclass order by fare nulls first, passenger_id) as fare_lag_1,
 lead(fare, 1) over (partition by pclass order by fare nulls first, passenger_id) as fare_lead_1"""
GLOBAL_PERCENTILE = " percent_rank() over (order by fare nulls first) as global_fare_percentile"

SCORE = """
 least(greatest(
  cast(0.5 as double)
  + case when pclass = 1 then cast(0.3 as double) when pclass = 2 then cast(0.1 as double) else cast(-0.2 as double) end
  + case when sex = 'FEMALE' then cast(0.4 as double) else cast(-0.3 as double) end
  + case when age < 15 then cast(0.2 as double) when age > 60 then cast(-0.1 as double) else cast(0 as double) end
  + case when fare > 50 then cast(0.15 as double) when fare < 10 then cast(-0.15 as double) else cast(0 as double) end
  + case when family_size between 2 and 4 then cast(0.1 as double) when family_size > 4 then cast(-0.15 as double) else cast(0 as double) end,
  cast(0 as double)), cast(1 as double)) as survival_score"""

CORRELATED = ("survived", "pclass", "age", "sibsp", "parch", "fare", "family_size")


def _fact(columns: str) -> str:
    return f"with {FACT} select {columns} from fact"


def _ranked(columns: str) -> str:
    return f"with {PASSENGERS} select passenger_id, {columns} from p"


def _correlations() -> str:
    return " union all ".join(
        f"select '{a}' as feature1, '{b}' as feature2, "
        f"round(corr(coalesce({a}, 0), coalesce({b}, 0)), 6) as correlation from f"
        for a in CORRELATED
        for b in CORRELATED
        if a != b
    )


def _pivot(value: str, condition: str) -> str:
    return value.replace("@", condition)


def _pivot_survival() -> str:
    cells = []
    for label, test in (("null", "sex is null"), ("FEMALE", "sex = 'FEMALE'"), ("MALE", "sex = 'MALE'")):
        cells.append(f'avg(survived) filter (where {test}) as "{label}_survival_rate"')
        cells.append(f'nullif(count(*) filter (where {test}), 0) as "{label}_count"')
    return f"with {FEATURES} select pclass, {', '.join(cells)} from f group by pclass"


def _pivot_fare() -> str:
    cells = []
    for c in (1, 2, 3):
        cells.append(f'avg(fare) filter (where pclass = {c}) as "{c}_avg_fare"')
        cells.append(f'max(fare) filter (where pclass = {c}) as "{c}_max_fare"')
    return f"with {FEATURES} select embarked, {', '.join(cells)} from f group by embarked"


def _inventory() -> str:
    names = ("customer", "orders", "lineitem", "part", "supplier", "nation", "region")
    counts = [f"select '{t}' as table_name, count(*) as row_count from {t}" for t in names]
    return " union all ".join([*counts, "select 'partsupp', cast(null as bigint)"])


ORDER_FIELDS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

SURVIVAL_STATS = """
 select pclass, sex, age_bucket, fare_bucket, count(*) as passenger_count, avg(survived) as survival_rate,
  avg(fare) as avg_fare, round(stddev_samp(fare), 6) as stddev_fare, min(fare) as min_fare,
  max(fare) as max_fare, avg(age) as avg_age, count(distinct embarked) as distinct_ports
 from f group by pclass, sex, age_bucket, fare_bucket"""
COHORTS = """
 select embarked, pclass, cast(sum(survived) as bigint) as survivors, count(*) as total_passengers,
  avg(fare) as avg_fare, count(*) filter (where sex = 'MALE') as male_count,
  count(*) filter (where sex = 'FEMALE') as female_count,
  cast(sum(survived) as double) / count(*) as survival_rate
 from f group by embarked, pclass"""
FAMILIES = """
 select family_size, pclass, avg(survived) as family_survival_rate, count(*) as family_count,
  avg(fare) as avg_fare_paid
 from f group by family_size, pclass"""


def oracle_sql() -> dict[str, str]:
    transformed = ", ".join((FARE_RANKS, AGE_RANK, FARE_CUMSUM, AGE_MOVING_AVG, FARE_NEIGHBOURS, GLOBAL_PERCENTILE, SCORE))
    feed_columns = "orderkey, custkey, orderstatus, totalprice, orderdate, orderpriority, clerk, shippriority, order_revenue, op"
    order_part = "orderkey, custkey, orderstatus, totalprice, orderdate, orderpriority, clerk, shippriority"
    fact_all = ", ".join(FACT_COLUMNS)
    comparable = """
     select a.pclass, a.sex, cast(count(*) as double) as pair_count,
      cast(sum(a.survived) as double) as p1_survived, cast(sum(b.survived) as double) as p2_survived,
      cast(sum(a.survived * b.survived) as double) as both_survived,
      coalesce(sum(a.fare), 0) as p1_fare, coalesce(sum(b.fare), 0) as p2_fare
     from p a join p b on a.pclass = b.pclass and a.sex = b.sex and a.embarked = b.embarked and abs(a.age - b.age) < 5
     group by a.pclass, a.sex"""
    refreshed = f"with {MERGED} {TOTALS.format(fact='merged')}"
    fare_ranks = _ranked(FARE_RANKS)
    percentile = _ranked(GLOBAL_PERCENTILE)
    stats_all = f"with {FEATURES}, s as ({SURVIVAL_STATS}), c as ({COHORTS}), m as ({FAMILIES})"
    twice = FACT + SAMPLE + feed("first_feed", "42b") + feed("second_feed", "42c")
    found = {
        "scan_orders": f"select {ORDER_FIELDS} from orders",
        "table_inventory": _inventory(),
        "row_counts": f"""with {FACT}
            select 'dim_customer' as table_name, count(distinct c_custkey) as row_count from customer
            union all select 'fact_orders', count(*) from fact
            union all select 'agg_customer_revenue', count(distinct custkey) from fact""",
        "customer_geography": """
            select c_custkey as custkey, c_name as name, c_acctbal as acctbal, c_mktsegment as mktsegment,
             n_name as nation, r_name as region
            from customer left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey""",
        "dim_customer": """
            select distinct c_custkey as custkey, c_name as name, c_acctbal as acctbal, c_mktsegment as mktsegment,
             n_name as nation, r_name as region
            from customer left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey""",
        "order_revenue": f"with {REVENUE} select l_orderkey, cast(order_revenue as double) as order_revenue from rev",
        "orders_enriched": f"with {ENRICHED} select {order_part}, cast(order_revenue as double) as order_revenue from enriched",
        "order_rankings": _fact("orderkey, custkey, rn_latest, revenue_rank"),
        "rolling_30d_revenue": _fact("orderkey, custkey, orderdate, rolling_30d_revenue"),
        "order_windows_skewed": _fact(fact_all).replace("o_custkey as custkey", "o_custkey % 3 as custkey"),
        "latest_order": f"with {FACT} select {order_part}, order_revenue from fact where rn_latest = 1",
        "fact_orders": _fact(fact_all),
        "agg_customer_revenue": f"with {FACT} {TOTALS.format(fact='fact')}",
        "cdc_sample": f"with {ENRICHED} {SAMPLE} select {order_part}, cast(order_revenue as double) as order_revenue from sample",
        "cdc_feed": f"with {FEED} select {feed_columns} from feed",
        "cdc_op_breakdown": f"with {FEED} select op, count(*) as count from feed group by op",
        "cdc_dedup": f"""with {twice},
            both_feeds as (select *, 1 as round from first_feed union all select *, 2 as round from second_feed),
            placed as (select *, row_number() over (partition by orderkey order by round desc) as place from both_feeds)
            select {feed_columns} from placed where place = 1""",
        "cdc_staged": f"with {STAGED} select {feed_columns}, rn_latest, revenue_rank, rolling_30d_revenue from staged",
        "merge_fact_orders": f"with {MERGED} select {fact_all} from merged",
        "merge_counts": f"with {MERGED} select (select count(*) from fact) as rows_before, count(*) as rows_after from merged",
        "merge_conflicts": f"""with {STAGED},
            again as (select orderkey, op from staged union all select orderkey + 20000000, op from staged),
            seen as (select a.op, f.orderkey is not null as matched from again a left join fact f on a.orderkey = f.orderkey)
            select op, matched, count(*) as changes from seen
            where not (matched and op in ('U', 'D') or not matched and op = 'I') group by op, matched""",
        "agg_refresh_full": refreshed,
        "agg_refresh_incremental": refreshed,
        "agg_refresh_touched": refreshed,
        "staged_view": f"with {STAGED} select op, count(*) as changes, cast(sum(orderkey) as bigint) as key_sum from staged group by op",
        "quarantined_orders": """
            select case when bad then null else o_orderkey end as o_orderkey,
             case when bad then null else o_custkey end as o_custkey,
             case when bad then null else o_totalprice end as o_totalprice,
             case when bad then substring('{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',', 1, 20) end as record
            from (select *, o_orderkey % 50 = 0 as bad from orders)""",
        "versioned_facts_after_cycle": f"with {MERGED} select {fact_all} from merged",
        "versioned_totals_after_cycle": refreshed,
        "change_cycle": f"""with {MERGED}
            select 'staged_changes' as table_name, count(*) as row_count from staged
            union all select 'fact_orders', count(*) from merged
            union all select 'agg_customer_revenue', count(distinct custkey) from merged""",
        "passenger_cast": f"""with {PASSENGERS}
            select passenger_id, survived, pclass, sex,
             case when passenger_id % 211 = 0 then null else age end as age, sibsp,
             case when passenger_id % 223 = 0 then null else parch end as parch, fare, embarked, alone from p""",
        "cents_cumsum": _ranked(CENTS),
        "cents_cumsum_chunked": _ranked(CENTS),
        "written_facts_after_cycle": f"with {MERGED} select {fact_all} from merged",
        "written_totals_after_cycle": refreshed,
        "written_passengers": f"with {FEATURES} select *, {transformed} from f",
        "written_survival_statistics": f"with {FEATURES} {SURVIVAL_STATS}",
        "written_cohorts": f"with {FEATURES} {COHORTS}",
        "written_families": f"with {FEATURES} {FAMILIES}",
        "catalog_listing": """
            select 'nation' as table_name, true as database_listed, true as table_exists, count(*) as row_count from nation
            union all select 'supplier', true, true, count(*) from supplier""",
        "cross_pairs": f"""with {PASSENGERS}
            select a.pclass, cast(count(*) as double) as pair_count from p a cross join p b group by a.pclass""",
        "fare_ranks": fare_ranks,
        "fare_ranks_chunked": fare_ranks,
        "age_dense_rank": _ranked(AGE_RANK),
        "age_dense_rank_chunked": _ranked(AGE_RANK),
        "fare_cumsum": _ranked(FARE_CUMSUM),
        "fare_cumsum_chunked": _ranked(FARE_CUMSUM),
        "age_moving_avg": _ranked(AGE_MOVING_AVG),
        "fare_lag_lead": _ranked(FARE_NEIGHBOURS),
        "fare_neighbours_chunked": _ranked(f"{AGE_MOVING_AVG}, {FARE_NEIGHBOURS}"),
        "global_percentile": percentile,
        "global_percentile_chunked": percentile,
        "family_features": f"with {FEATURES} select passenger_id, family_size, is_large_family, is_solo, fare_per_family_member from f",
        "fare_age_buckets": f"with {FEATURES} select passenger_id, fare_bucket, age_bucket from f",
        "feature_flags": f"with {FEATURES} select passenger_id, high_fare_solo, first_class_child from f",
        "survival_stats": f"with {FEATURES} {SURVIVAL_STATS}",
        "cohort_analysis": f"with {FEATURES} {COHORTS}",
        "family_patterns": f"with {FEATURES} {FAMILIES}",
        "pivot_survival": _pivot_survival(),
        "pivot_fare": _pivot_fare(),
        "comparable_pairs": f"with {PASSENGERS} {comparable}",
        "comparable_pairs_chunked": f"with {PASSENGERS} {comparable}",
        "correlation_matrix": f"with {FEATURES} {_correlations()}",
        "survival_score": f"with {FEATURES} select passenger_id, {SCORE} from f",
        "survival_score_udf": f"with {FEATURES} select passenger_id, {SCORE} from f",
        "passenger_transformed": f"with {FEATURES} select *, {transformed} from f",
        "passenger_transformed_chunked": f"with {FEATURES} select *, {transformed} from f",
        "passenger_marts": stats_all + """
            select 'passenger_transformed' as table_name, count(*) as row_count from f
            union all select 'survival_statistics', count(*) from s
            union all select 'cohort_analysis', count(*) from c
            union all select 'family_survival_patterns', count(*) from m""",
        "write_readback": """
            select o_orderstatus, count(*) as row_count, cast(sum(o_orderkey) as bigint) as key_sum,
             cast(sum(cast(o_totalprice as decimal(15,2))) as double) as price_sum
            from orders group by o_orderstatus""",
        "insert_overwrite": f"select {ORDER_FIELDS} from orders",
        "format_roundtrip": " union all ".join(
            f"select '{f}' as file_format, {ORDER_FIELDS} from orders" for f in ("parquet", "csv", "json")
        ),
        "array_transform": """
            select vec_id, len(embedding) as n, cast(unnest(range(len(embedding))) as bigint) as pos,
             -cast(unnest(embedding) as double) + len(embedding) as e from embeddings""",
        "struct_udf": "select l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) as discounted from lineitem",
        "dedupe_columns": """
            select o_orderkey as orderkey, o_custkey as custkey, o_totalprice as amount,
             o_totalprice * 2 as amount_dedup_1, o_totalprice * 4 as amount_dedup_2 from orders""",
        "widen_types": """
            select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, cast(l_quantity as double) as quantity,
             l_returnflag from lineitem""",
    }
    found["written_dim_customer"] = found["dim_customer"]
    found["merge_by_file"] = found["merge_by_partition"] = found["merge_fact_orders"]
    found["orders_enriched_bucketed"] = found["orders_enriched"]
    return found
