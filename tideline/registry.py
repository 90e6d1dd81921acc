"""Named queries over a folder of Parquet tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions import columns as cols
from tideline.functions.features import fare_age_buckets, family_features, feature_flags
from tideline.functions.scoring import discounted_price
from tideline.operators import changes as ch
from tideline.operators import pairs, retract, sinks, stats
from tideline.operators import windows as w
from tideline.operators.groups import GROUP_ROWS, stored
from tideline.operators.sampling import hash_sample
from tideline.operators.versions import VersionedTable
from tideline.plans import jobs, star, versioned
from tideline.plans import passengers as pax
from tideline.session import fresh_folder, scratch_database
from tideline.sources import formats, tables
from tideline.sources.passengers import cast_passengers, passengers, passengers_as_text

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ORDER_FIELDS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
FEED_COLUMNS = [*star.ORDER_COLUMNS, "op"]
SALT = str(jobs.SEED)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def scan(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return tables.read_table(spark, table, folder)


def as_double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("double") for name in names})


def few_rows(df: DataFrame) -> int:
    """A group limit so low that even test tables take the chunked path, and no higher than for large ones."""
    return max(50, min(GROUP_ROWS, df.count() // 16))


# ---- sources ------------------------------------------------------------------------


@query
def scan_orders(spark, folder):
    return scan(spark, folder, "orders").select(*ORDER_FIELDS)


@query
def table_inventory(spark, folder):
    return tables.table_inventory(spark, tables.load_tables(spark, folder))


@query
def format_roundtrip(spark, folder):
    orders = scan(spark, folder, "orders").select(*ORDER_FIELDS)
    parts = []
    for file_format in formats.FORMATS:
        path = fresh_folder(spark, f"orders-{file_format}")
        formats.write_files(orders, path, file_format)
        stored = formats.read_files(spark, path, file_format, orders.schema)
        parts.append(stored.select(F.lit(file_format).alias("file_format"), *ORDER_FIELDS))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def quarantined_orders(spark, folder):
    """Orders as JSON lines of which every fiftieth is cut short: the good rows, and the broken records."""
    orders = scan(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    record = F.to_json(F.struct(*orders.columns))
    lines = orders.select(F.when(F.col("o_orderkey") % 50 == 0, F.substring(record, 1, 20)).otherwise(record).alias("value"))
    path = fresh_folder(spark, "orders-lines")
    lines.write.text(path)
    checked = formats.read_checked(spark, path, "json", orders.schema)
    good = checked.good.withColumn("record", F.lit(None).cast("string"))
    broken = checked.broken.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in orders.schema], "record")
    return good.unionByName(broken)


# ---- star schema --------------------------------------------------------------------


def geography(spark, folder):
    return star.customer_geography(*[scan(spark, folder, t) for t in ("customer", "nation", "region")])


def fact(spark, folder):
    return star.fact_orders(scan(spark, folder, "orders"), scan(spark, folder, "lineitem"))


@query
def customer_geography(spark, folder):
    return geography(spark, folder)


@query
def dim_customer(spark, folder):
    return star.dim_customer(geography(spark, folder))


@query
def order_revenue(spark, folder):
    return as_double(star.order_revenue(scan(spark, folder, "lineitem")), "order_revenue")


@query
def orders_enriched(spark, folder):
    enriched = star.orders_enriched(scan(spark, folder, "orders"), scan(spark, folder, "lineitem"))
    return as_double(enriched, "order_revenue")


@query
def orders_enriched_bucketed(spark, folder):
    """From tables in buckets of the order key: nothing is shuffled below the join."""
    database = scratch_database(spark)
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        sinks.write_bucketed(scan(spark, folder, name), f"{database}.{name}", key, 8)
    enriched = star.orders_enriched(spark.table(f"{database}.orders"), spark.table(f"{database}.lineitem"))
    return as_double(enriched, "order_revenue")


@query
def order_rankings(spark, folder):
    return fact(spark, folder).select("orderkey", "custkey", "rn_latest", "revenue_rank")


@query
def rolling_30d_revenue(spark, folder):
    return fact(spark, folder).select("orderkey", "custkey", "orderdate", "rolling_30d_revenue")


@query
def latest_order(spark, folder):
    latest = star.latest_order_of_each(scan(spark, folder, "orders"), scan(spark, folder, "lineitem"))
    return as_double(latest, "order_revenue")


@query
def fact_orders(spark, folder):
    return fact(spark, folder)


@query
def order_windows_skewed(spark, folder):
    # Three customers hold all orders, a third each, and every one of them is chunked.
    orders = scan(spark, folder, "orders")
    merged = orders.withColumn("o_custkey", F.col("o_custkey") % 3)
    limit = few_rows(orders)
    return star.fact_orders(merged, scan(spark, folder, "lineitem"), limit, limit)


@query
def agg_customer_revenue(spark, folder):
    return star.agg_customer_revenue(fact(spark, folder))


@query
def row_counts(spark, folder):
    database = scratch_database(spark)
    try:
        written = jobs.build_star_schema(spark, tables.load_tables(spark, folder), database)
        return jobs.audit(spark, written)
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


# ---- changes ------------------------------------------------------------------------


def sample(spark, folder):
    """A sample of orders, and revenue for those only."""
    picked = stored(
        hash_sample(scan(spark, folder, "orders"), "o_orderkey", jobs.SAMPLE_SIZE, SALT)
    )
    enriched = star.orders_enriched(picked, star.lines_of(picked, scan(spark, folder, "lineitem")))
    return as_double(enriched, "order_revenue")


def feed(spark, folder, salt="b"):
    return ch.make_changes(sample(spark, folder), f"{SALT}{salt}")


def staged(spark, folder):
    """The staged feed, written to the shared folder and read back."""
    return stored(ch.stage_changes(ch.last_per_key(feed(spark, folder))))


@query
def cdc_sample(spark, folder):
    return sample(spark, folder)


@query
def cdc_feed(spark, folder):
    return feed(spark, folder).select(*FEED_COLUMNS)


@query
def cdc_op_breakdown(spark, folder):
    return ch.count_by_op(feed(spark, folder))


@query
def cdc_dedup(spark, folder):
    first = feed(spark, folder, "b").withColumn("seq", F.lit(1))
    second = feed(spark, folder, "c").withColumn("seq", F.lit(2))
    return ch.last_per_key(first.unionByName(second)).select(*FEED_COLUMNS)


@query
def cdc_staged(spark, folder):
    """Staged twice over: into a new table, then into the one that is there by then."""
    changes, table = staged(spark, folder), f"{scratch_database(spark)}.{jobs.STAGED}"
    sinks.insert_overwrite(changes, table)
    sinks.overwrite_existing(changes, table)
    return spark.table(table).select(*FEED_COLUMNS, *star.WINDOW_COLUMNS)


@query
def merge_fact_orders(spark, folder):
    return ch.apply_changes(fact(spark, folder), staged(spark, folder))


@query
def merge_counts(spark, folder):
    target = fact(spark, folder)
    merged = ch.apply_changes(target, staged(spark, folder))
    before = target.select(F.count(F.lit(1))).scalar()
    return merged.agg(F.count(F.lit(1)).alias("rows_after")).select(
        before.alias("rows_before"), "rows_after"
    )


@query
def merge_conflicts(spark, folder):
    changes = staged(spark, folder).select("orderkey", "op")
    shifted = changes.withColumn("orderkey", F.col("orderkey") + 2 * ch.INSERT_KEY_OFFSET)
    return ch.merge_conflicts(fact(spark, folder), changes.unionByName(shifted))


@query
def agg_refresh_full(spark, folder):
    return star.agg_customer_revenue(merge_fact_orders(spark, folder))


# Folders of the tables as they stand before a change, per session and folder of sources.
STANDING: dict[tuple[str, str], str] = {}


def standing(spark, folder) -> str:
    """Facts and state of the totals as stored tables; a session writes them once, as they would stand."""
    name = (spark.sparkContext.applicationId, folder)
    if name not in STANDING:
        root = fresh_folder(spark, "standing")
        versioned.build_versioned_star(spark, tables.load_tables(spark, folder), root, 8)
        STANDING[name] = root
    return STANDING[name]


@query
def agg_refresh_incremental(spark, folder):
    """The stored state, and what the changes take out of the stored facts and put in."""
    root, changes = standing(spark, folder), staged(spark, folder)
    target = versioned.table(spark, root, versioned.FACTS).read()
    state = versioned.table(spark, root, versioned.STATE).read()
    moved = retract.moved_rows(target, changes)
    renewed = retract.state_changes(state, moved.removed, moved.added, lambda some: moved.facts_of(target, some))
    return retract.totals_of(retract.with_changes(state, renewed))


@query
def agg_refresh_touched(spark, folder):
    # The facts are read five times over, so they are written first, as a table would be.
    target, changes = stored(fact(spark, folder)), staged(spark, folder)
    return ch.refresh_touched(
        star.agg_customer_revenue(target),
        ch.apply_changes(target, changes),
        stored(ch.touched_groups(target, changes)),
        star.agg_customer_revenue,
    )


@query
def staged_view(spark, folder):
    """The staged changes through a temporary view and SQL."""
    view = f"staged_{uuid.uuid4().hex}"
    staged(spark, folder).createOrReplaceTempView(view)
    try:
        return stored(spark.sql(f"SELECT op, count(*) AS changes, sum(orderkey) AS key_sum FROM {view} GROUP BY op"))
    finally:
        spark.catalog.dropTempView(view)


@query
def merge_by_partition(spark, folder):
    """A merge into a table by year that reads and writes only years it touches."""
    def dated(df):
        return df.withColumn("order_year", F.year("orderdate"))

    table = f"{scratch_database(spark)}.fact_orders"
    sinks.overwrite_partitions(dated(fact(spark, folder)), table, "order_year")
    sinks.merge_partitions(dated(staged(spark, folder)), table, "order_year")
    return spark.table(table).drop("order_year")


@query
def merge_by_file(spark, folder):
    """A merge that rewrites only the files that have a changed key."""
    table = VersionedTable(spark, fresh_folder(spark, "facts"))
    table.replace(fact(spark, folder), "orderkey", n_files=8)
    return table.read(table.merge(staged(spark, folder)).number)


def cycled(spark, folder) -> str:
    """A versioned cycle, and the same batch once more, which must change nothing."""
    root = fresh_folder(spark, "cycle")
    versioned.build_versioned_star(spark, tables.load_tables(spark, folder), root, 8)
    first = versioned.run_versioned_cycle(spark, root)
    if versioned.run_versioned_cycle(spark, root) != first:
        raise RuntimeError("a batch was applied twice")
    return root


@query
def versioned_facts_after_cycle(spark, folder):
    return versioned.table(spark, cycled(spark, folder), versioned.FACTS).read()


@query
def versioned_totals_after_cycle(spark, folder):
    return versioned.totals(spark, cycled(spark, folder))


@query
def change_cycle(spark, folder):
    database = scratch_database(spark)
    try:
        jobs.build_star_schema(spark, tables.load_tables(spark, folder), database)
        return jobs.audit(spark, jobs.run_change_cycle(spark, database))
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def written(spark, table: str, *job) -> DataFrame:
    """The rows of one table after jobs that write into a database of their own."""
    database = scratch_database(spark)
    try:
        for step in job:
            step(database)
        return stored(spark.table(f"{database}.{table}"))
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def star_job(spark, folder):
    return lambda database: jobs.build_star_schema(spark, tables.load_tables(spark, folder), database)


def cycle_job(spark):
    return lambda database: jobs.run_change_cycle(spark, database)


def marts_job(spark, folder):
    return lambda database: jobs.build_passenger_marts(spark, tables.load_tables(spark, folder), database)


@query
def written_dim_customer(spark, folder):
    return written(spark, "dim_customer", star_job(spark, folder))


@query
def written_facts_after_cycle(spark, folder):
    return written(spark, "fact_orders", star_job(spark, folder), cycle_job(spark))


@query
def written_totals_after_cycle(spark, folder):
    return written(spark, "agg_customer_revenue", star_job(spark, folder), cycle_job(spark))


@query
def written_passengers(spark, folder):
    return written(spark, "passenger_transformed", marts_job(spark, folder))


@query
def written_survival_statistics(spark, folder):
    found = written(spark, "survival_statistics", marts_job(spark, folder))
    return found.withColumn("stddev_fare", F.round("stddev_fare", 6))


@query
def written_cohorts(spark, folder):
    return written(spark, "cohort_analysis", marts_job(spark, folder))


@query
def written_families(spark, folder):
    return written(spark, "family_survival_patterns", marts_job(spark, folder))


@query
def catalog_listing(spark, folder):
    """Tables written from the given ones, as the catalog lists them, with their rows and whether they exist."""
    database = scratch_database(spark)
    try:
        known = tables.list_databases(spark).filter(F.col("namespace") == database).count()
        for name in ("nation", "supplier"):
            sinks.overwrite_table(scan(spark, folder, name), f"{database}.{name}")
        listed = tables.list_catalog(spark, database).filter("NOT isTemporary").collect()
        rows = [
            (row["tableName"], known == 1, tables.table_exists(spark, f"{database}.{row['tableName']}"),
             spark.table(f"{database}.{row['tableName']}").count())
            for row in listed
        ]
        return spark.createDataFrame(rows, "table_name string, database_listed boolean, table_exists boolean, row_count bigint")
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


# ---- passengers ---------------------------------------------------------------------


def people(spark, folder):
    return passengers(scan(spark, folder, "customer"))


def featured(spark, folder):
    return pax.passenger_features(people(spark, folder))


def windowed(spark, folder, step, measures, group_rows=GROUP_ROWS):
    by, order = step
    result = w.window_columns(people(spark, folder), by, order, measures, group_rows)
    return result.select("passenger_id", *measures)


def chunked(spark, folder, step, measures):
    return windowed(spark, folder, step, measures, few_rows(scan(spark, folder, "customer")))


@query
def passenger_cast(spark, folder):
    return cast_passengers(passengers_as_text(people(spark, folder)))


@query
def cross_pairs(spark, folder):
    return as_double(pairs.cross_pair_counts(people(spark, folder)), "pair_count")


@query
def fare_ranks(spark, folder):
    return windowed(spark, folder, pax.BY_CLASS, pax.FARE_RANKS)


@query
def fare_ranks_chunked(spark, folder):
    return chunked(spark, folder, pax.BY_CLASS, pax.FARE_RANKS)


@query
def age_dense_rank(spark, folder):
    return windowed(spark, folder, pax.BY_SEX_CLASS, pax.AGE_RANK)


@query
def age_dense_rank_chunked(spark, folder):
    return chunked(spark, folder, pax.BY_SEX_CLASS, pax.AGE_RANK)


@query
def fare_cumsum(spark, folder):
    return windowed(spark, folder, pax.BY_PORT, pax.FARE_CUMSUM)


@query
def fare_cumsum_chunked(spark, folder):
    return chunked(spark, folder, pax.BY_PORT, pax.FARE_CUMSUM)


def cents(spark, folder, limit=GROUP_ROWS):
    """Running sums of fares whose cents no double holds."""
    odd = F.col("fare") + (F.col("passenger_id") % 100) / 100
    riders = people(spark, folder).withColumn("fare", F.round(odd, 2))
    by, order = pax.BY_PORT
    return w.window_columns(riders, by, order, pax.FARE_CUMSUM, limit).select("passenger_id", *pax.FARE_CUMSUM)


@query
def cents_cumsum(spark, folder):
    return cents(spark, folder)


@query
def cents_cumsum_chunked(spark, folder):
    return cents(spark, folder, few_rows(scan(spark, folder, "customer")))


@query
def age_moving_avg(spark, folder):
    return windowed(spark, folder, pax.BY_CLASS, pax.AGE_MOVING_AVG)


@query
def fare_lag_lead(spark, folder):
    return windowed(spark, folder, pax.BY_CLASS, pax.FARE_NEIGHBOURS)


@query
def fare_neighbours_chunked(spark, folder):
    return chunked(spark, folder, pax.BY_CLASS, pax.AGE_MOVING_AVG | pax.FARE_NEIGHBOURS)


@query
def global_percentile(spark, folder):
    return windowed(spark, folder, pax.BY_ALL, pax.GLOBAL_PERCENTILE)


@query
def global_percentile_chunked(spark, folder):
    return chunked(spark, folder, pax.BY_ALL, pax.GLOBAL_PERCENTILE)


@query
def passenger_transformed(spark, folder):
    return pax.passenger_transformed(people(spark, folder))


@query
def passenger_transformed_chunked(spark, folder):
    customer = scan(spark, folder, "customer")
    return pax.passenger_transformed(passengers(customer), few_rows(customer))


@query
def passenger_marts(spark, folder):
    database = scratch_database(spark)
    try:
        written = jobs.build_passenger_marts(spark, tables.load_tables(spark, folder), database)
        return jobs.audit(spark, written)
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


@query
def family_features_query(spark, folder):
    return family_features(people(spark, folder)).select(
        "passenger_id", "family_size", "is_large_family", "is_solo", "fare_per_family_member"
    )


@query
def fare_age_buckets_query(spark, folder):
    return fare_age_buckets(people(spark, folder)).select("passenger_id", "fare_bucket", "age_bucket")


@query
def feature_flags_query(spark, folder):
    prepared = fare_age_buckets(family_features(people(spark, folder)))
    return feature_flags(prepared).select("passenger_id", "high_fare_solo", "first_class_child")


@query
def survival_stats(spark, folder):
    result = stats.survival_stats(featured(spark, folder))
    return result.withColumn("stddev_fare", F.round("stddev_fare", 6))


@query
def cohort_analysis(spark, folder):
    return stats.cohort_analysis(featured(spark, folder))


@query
def family_patterns(spark, folder):
    return stats.family_patterns(featured(spark, folder))


@query
def pivot_survival(spark, folder):
    return stats.pivot_survival(featured(spark, folder))


@query
def pivot_fare(spark, folder):
    return stats.pivot_fare(featured(spark, folder))


PAIR_TOTALS = ["pair_count", "p1_survived", "p2_survived", "both_survived", "p1_fare", "p2_fare"]


@query
def comparable_pairs(spark, folder):
    return as_double(pairs.comparable_pairs(people(spark, folder)), *PAIR_TOTALS)


@query
def comparable_pairs_chunked(spark, folder):
    # Fewer rows than a group has ages, so the sweep over ages is cut in chunks.
    return as_double(pairs.comparable_pairs(people(spark, folder), 10, 10), *PAIR_TOTALS)


@query
def correlation_matrix(spark, folder):
    result = stats.correlation_matrix(featured(spark, folder))
    return result.withColumn("correlation", F.round("correlation", 6))


@query
def survival_score(spark, folder):
    return pax.scored_natively(people(spark, folder))


@query
def survival_score_udf(spark, folder):
    return pax.scored_by_function(people(spark, folder))


# ---- sinks and helpers --------------------------------------------------------------


@query
def write_readback(spark, folder):
    def reading(stored: DataFrame) -> DataFrame:
        return stored.groupBy("o_orderstatus").agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum("o_orderkey").alias("key_sum"),
            F.sum(cols.money("o_totalprice")).cast("double").alias("price_sum"),
        )

    database = scratch_database(spark)
    try:
        orders = scan(spark, folder, "orders").select(*ORDER_FIELDS)
        return sinks.write_check(orders, f"{database}.orders_copy", reading)
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


@query
def insert_overwrite(spark, folder):
    table = f"{scratch_database(spark)}.orders_copy"
    orders = scan(spark, folder, "orders").select(*ORDER_FIELDS)
    sinks.insert_overwrite(orders, table)
    sinks.insert_overwrite(orders, table)
    return spark.table(table)


@query
def array_transform(spark, folder):
    vectors = scan(spark, folder, "embeddings").withColumn(
        "embedding", F.col("embedding").cast("array<double>")
    )
    n = F.size("embedding")
    changed = vectors.select(
        "vec_id", n.cast("bigint").alias("n"), F.posexplode(cols.transform_elements("embedding", lambda e: -e + n)).alias("pos", "e")
    )
    return changed.select("vec_id", "n", F.col("pos").cast("bigint").alias("pos"), "e")


@query
def struct_udf(spark, folder):
    discounted = discounted_price("l_extendedprice", "l_discount").alias("discounted")
    return scan(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", discounted)


@query
def dedupe_columns(spark, folder):
    price = F.col("o_totalprice")
    repeated = scan(spark, folder, "orders").select(
        F.col("o_orderkey").alias("orderkey"),
        F.col("o_custkey").alias("custkey"),
        price.alias("amount"),
        (price * 2).alias("amount"),
        (price * 4).alias("amount"),
    )
    return cols.dedupe_columns(repeated)


@query
def widen_types(spark, folder):
    narrow = scan(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("float").alias("quantity"), "l_returnflag"
    )
    return cols.widen_types(narrow)


for name in ("family_features", "fare_age_buckets", "feature_flags"):
    QUERIES[name] = QUERIES.pop(f"{name}_query")
