"""The test tables' events as envelopes of the engagement model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import model as M

#: Arrivals in a bucket, in which offsets are given out.
BUCKET = 1 << 18

#: The same adapter in SQL for the other engine. Session time zone UTC.
ENVELOPE_SQL = """
base as (select event_id as n, ts as event_time, user_id, event_type as et, value from events),
arr as (
  select n, event_time, user_id, et, value, n + case when n % 97 = 0 then 200 else 0 end as arrival_rank, 0 as copy_no from base
  union all select n, event_time, user_id, et, value, n + 50, 1 from base where n % 101 = 0
  union all select n, event_time, user_id, et, value + 1000, n + 60, 2 from base where n % 103 = 0),
env as (
  select cast(user_id % 4 as int) as kafka_partition,
    cast(row_number() over (partition by user_id % 4 order by arrival_rank, n, copy_no) - 1 as bigint) as kafka_offset,
    '1.0' as schema_version, concat('evt-', cast(n as varchar)) as event_id,
    case when n % 50 < 12 then concat('web-', lpad(cast(n % 50 + 1 as varchar), 2, '0'))
         when n % 50 < 20 then concat('ios-', lpad(cast(n % 50 - 11 as varchar), 2, '0'))
         when n % 50 < 28 then concat('android-', lpad(cast(n % 50 - 19 as varchar), 2, '0'))
         when n % 50 < 38 then concat('backend-', lpad(cast(n % 50 - 27 as varchar), 2, '0'))
         when n % 50 < 44 then concat('campaign-', lpad(cast(n % 50 - 37 as varchar), 2, '0'))
         else concat('partner-', lpad(cast(n % 50 - 43 as varchar), 2, '0')) end as source_id,
    sha256(concat('user-', cast(user_id as varchar))) as user_token,
    case et when 'view' then 'page_view' when 'click' then 'product_view' when 'purchase' then 'checkout'
            when 'signup' then 'add_to_cart' else 'search' end as event_type,
    event_time, event_time + interval 5 minute as arrival_time,
    case when n % 37 = 0 then 'essential_only' else 'analytics_allowed' end as consent_state,
    concat('page-', cast(cast(floor(value) as bigint) as varchar)) as page_id,
    case when n % 5 = 0 then concat('campaign-', cast(n % 40 as varchar)) end as campaign_id
  from arr)"""


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table with late arrivals, exact copies and conflicting copies, dealt to four partitions."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    base = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_id").alias("n"), F.col("ts").cast("timestamp").alias("event_time"), "user_id",
        F.col("event_type").alias("et"), "value",
    )
    n = F.col("n")

    def copies(rows: DataFrame, rank, number: int, more: int) -> DataFrame:
        return rows.withColumns({"value": F.col("value") + more, "arrival_rank": rank, "copy_no": F.lit(number)})

    arrivals = (
        copies(base, n + F.when(n % 97 == 0, 200).otherwise(0), 0, 0)
        .unionByName(copies(base.where(n % 101 == 0), n + 50, 1, 0))
        .unionByName(copies(base.where(n % 103 == 0), n + 60, 2, 1000))
    )
    # Offsets in two levels: how many rows the buckets before hold, and the place within the bucket.
    arrivals = arrivals.withColumns({"_partition": F.col("user_id") % 4, "_bucket": F.floor(F.col("arrival_rank") / BUCKET)})
    sizes = arrivals.groupBy("_partition", "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy("_partition").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_partition", "_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    arrivals = arrivals.join(starts, ["_partition", "_bucket"])
    order = Window.partitionBy("_partition", "_bucket").orderBy("arrival_rank", "n", "copy_no")
    sources = F.array(*[F.lit(s) for s in M.source_ids()])
    kinds = F.create_map(*[F.lit(x) for x in (
        "view", "page_view", "click", "product_view", "purchase", "checkout", "signup", "add_to_cart",
    )])
    return arrivals.select(
        (F.col("user_id") % 4).cast("int").alias("kafka_partition"),
        (F.col("_before") + F.row_number().over(order) - 1).cast("long").alias("kafka_offset"),
        F.lit(M.SCHEMA_VERSION).alias("schema_version"),
        F.concat(F.lit("evt-"), n.cast("string")).alias("event_id"),
        F.element_at(sources, (n % 50 + 1).cast("int")).alias("source_id"),
        F.sha2(F.concat(F.lit("user-"), F.col("user_id").cast("string")), 256).alias("user_token"),
        F.coalesce(kinds[F.col("et")], F.lit("search")).alias("event_type"),
        "event_time",
        (F.col("event_time") + F.expr("interval 5 minutes")).alias("arrival_time"),
        F.when(n % 37 == 0, "essential_only").otherwise("analytics_allowed").alias("consent_state"),
        F.concat(F.lit("page-"), F.floor("value").cast("string")).alias("page_id"),
        F.when(n % 5 == 0, F.concat(F.lit("campaign-"), (n % 40).cast("string"))).alias("campaign_id"),
    )
