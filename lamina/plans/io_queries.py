"""Queries over sinks, JSON payloads, event expressions and the stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lamina import fixed
from lamina.functions.exprs import threshold_flag
from lamina.operators import ingest as ing
from lamina.plans import oracle as sql
from lamina.plans.gold_queries import gold
from lamina.plans.joins import sized_broadcast
from lamina.plans.registry import register
from lamina.session import work_path
from lamina.sources import sinks, versions
from lamina.sources.json_dim import extract_json_fields, flatten_nested_record, json_records
from lamina.sources.tables import fact_frame, period_slices, read_table
from lamina.streaming.incremental import run_incremental, stream_source

EVENT_COLS = "event_id, ts, user_id, event_type, value, props"

# -- sinks -----------------------------------------------------------------------


@register("sink_overwrite_roundtrip", sql.GOLD_SELECT)
def q_sink_overwrite_roundtrip(spark, sf_dir):
    """A reload replaces data and schema, atomically: write the fact, then the gold fact
    (other columns) to the same table; what is read is the second, alone."""
    path = work_path(spark, "overwrite")
    versions.replace(fact_frame(spark, sf_dir), path)
    versions.replace(gold(spark, sf_dir), path)
    versions.remove_old(spark, path)
    return versions.read(spark, path)


@register("sink_partitioned_roundtrip", sql.GOLD_SELECT)
def q_sink_partitioned_roundtrip(spark, sf_dir):
    path = work_path(spark, "gold-by-period")
    sinks.write_table(gold(spark, sf_dir), path, partition_by=["period"])
    return sinks.read_back(spark, path)


@register("sink_table_roundtrip", sql.GOLD_SELECT)
def q_sink_table_roundtrip(spark, sf_dir):
    """By name in the catalog: made from the raw fact, replaced by the published one,
    with its schema, and read by name."""
    name, path = f"lamina_published_{uuid.uuid4().hex[:12]}", work_path(spark, "published")
    versions.publish(fact_frame(spark, sf_dir), name, path)
    versions.publish(gold(spark, sf_dir), name, path, partition_by=["period"])
    return spark.table(name)


@register("sink_append_roundtrip", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CASE WHEN year(o_orderdate) >= 1998 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
       CAST(year(o_orderdate) AS INT) AS o_year
FROM orders""")
def q_sink_append_roundtrip(spark, sf_dir):
    """Two waves appended (the second without one column) read back as one."""
    path = work_path(spark, "append")
    for wave in period_slices(spark, sf_dir):
        sinks.write_table(wave, path, mode="append")
    return sinks.read_back(spark, path, merge_schema=True)


@register("publish_reference", """
SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_quantity, l_extendedprice,
       CAST(year(l_shipdate) AS INT) AS ship_year
FROM lineitem""")
def q_publish_reference(spark, sf_dir):
    """Narrow projection of a reference table, published partitioned by year."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity",
        "l_extendedprice", F.year("l_shipdate").cast("int").alias("ship_year"))
    path = work_path(spark, "reference")
    sinks.write_table(li, path, partition_by=["ship_year"])
    return sinks.read_back(spark, path)


def region_dimension_export(spark, sf_dir):
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return nation.join(sized_broadcast(region), nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("area_code"),
        F.upper(F.substring("n_name", 1, 2)).alias("area_abbrev"),
        F.col("n_name").alias("area_name"), F.col("r_name").alias("region_name"))


DIM_EXPORT_SQL = """
SELECT n_nationkey AS area_code, upper(substr(n_name, 1, 2)) AS area_abbrev,
       n_name AS area_name, r_name AS region_name
FROM nation JOIN region ON n_regionkey = r_regionkey"""


@register("csv_export_roundtrip", DIM_EXPORT_SQL)
def q_csv_export_roundtrip(spark, sf_dir):
    dim = region_dimension_export(spark, sf_dir)
    path = work_path(spark, "dim-csv")
    sinks.export_csv(dim, path, single_file=True)
    return sinks.read_back(spark, path, fmt="csv", schema=dim.schema,
                           options={"header": "true"})


# -- JSON ------------------------------------------------------------------------


@register("json_flatten_dimension", """
SELECT n_nationkey AS area_code, upper(substr(n_name, 1, 2)) AS area_abbrev, n_name AS area_name,
       CASE WHEN r_regionkey IN (2, 3) THEN NULL ELSE r_name END AS region_name
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def q_json_flatten_dimension(spark, sf_dir):
    """Records shaped like a geography API answer, made by Spark from nation
    and region; the nested object arrives as plain text in one region, without the
    field in another and with a null field in a third."""
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    wide = nation.join(sized_broadcast(region), nation.n_regionkey == region.r_regionkey)
    head = [F.col("n_nationkey").alias("id"),
            F.upper(F.substring("n_name", 1, 2)).alias("code"), F.col("n_name").alias("name")]
    as_object = F.to_json(F.struct(*head, F.struct(F.col("r_regionkey").alias("id"),
                                                   F.col("r_name").alias("name")).alias("region")))
    as_text = F.to_json(F.struct(*head, F.col("r_name").alias("region")))
    lacking = F.to_json(F.struct(*head, F.struct(F.col("r_regionkey").alias("id")).alias("region")))
    with_null = F.regexp_replace(as_object, r'"region":\{.*\}\}$', '"region":{"name":null}}')
    key = F.col("r_regionkey")
    payload = wide.select(F.when(key == 4, as_text).when(key == 2, lacking).when(key == 3, with_null)
                          .otherwise(as_object).alias("payload"))
    return flatten_nested_record(
        payload, "payload",
        top={"area_code": ("id", "int"), "area_abbrev": ("code", "string"),
             "area_name": ("name", "string")},
        nested="region", nested_field="name", nested_alias="region_name")


@register("json_array_records", """
SELECT l_orderkey, CASE WHEN NOT bad THEN CAST(l_linenumber AS INTEGER) END AS line,
       CASE WHEN NOT bad THEN l_linestatus END AS mode, CASE WHEN NOT bad THEN l_returnflag END AS flag, bad
FROM (SELECT *, l_linenumber = 3 AND l_quantity > 40 AS bad FROM lineitem)""")
def q_json_array_records(spark, sf_dir):
    """An order's lines as one payload, an array of records, of which some hold a word in
    place of the number; the nested value is an object or plain text."""
    li = read_table(spark, sf_dir, "lineitem")
    bad = (F.col("l_linenumber") == 3) & (F.col("l_quantity") > 40)
    number = F.when(bad, F.lit("third")).otherwise(F.col("l_linenumber").cast("string"))
    number = F.when(bad, F.concat(F.lit('"'), number, F.lit('"'))).otherwise(number)
    flag = F.concat(F.lit('"'), "l_returnflag", F.lit('"'))
    nested = F.when(F.col("l_linenumber") % 2 == 0, flag).otherwise(F.concat(F.lit('{"name": '), flag, F.lit("}")))
    record = F.concat(F.lit('{"id": '), number, F.lit(', "mode": "'), "l_linestatus", F.lit('", "flag": '), nested, F.lit("}"))
    payload = (li.groupBy("l_orderkey").agg(F.array_join(F.collect_list(record), ", ").alias("lines"))
               .select("l_orderkey", F.concat(F.lit(" ["), "lines", F.lit("]")).alias("payload")))
    out = flatten_nested_record(
        json_records(payload, "payload", keep=("l_orderkey",)), "record",
        top={"line": ("id", "int"), "mode": ("mode", "string")},
        nested="flag", nested_field="name", nested_alias="flag", keep=("l_orderkey",), bad_alias="bad_record")
    return out.select("l_orderkey", "line", "mode", "flag", F.col("bad_record").isNotNull().alias("bad"))


@register("json_props_extract", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def q_json_props_extract(spark, sf_dir):
    return extract_json_fields(read_table(spark, sf_dir, "events"), "props", {"k": "int"},
                               keep=("event_id",))


# -- event expressions -------------------------------------------------------------


@register("threshold_label", f"""
SELECT event_id, value AS measure, CASE WHEN value >= {fixed.LABEL_THRESHOLD} THEN 1 ELSE 0 END AS label
FROM events""")
def q_threshold_label(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", F.col("value").alias("measure"),
                     threshold_flag("value", fixed.LABEL_THRESHOLD).alias("label"))


@register("event_key_unique", """
SELECT COUNT(*) AS n_rows, COUNT(*) AS n_keys, 36 AS min_len, 36 AS max_len FROM events""")
def q_event_key_unique(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select(F.expr("uuid()").alias("event_key"))
    return ev.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_distinct("event_key").alias("n_keys"),
                  F.min(F.length("event_key")).alias("min_len"),
                  F.max(F.length("event_key")).alias("max_len"))


@register("topk_latest", f"""
SELECT {EVENT_COLS} FROM events ORDER BY ts DESC, event_id DESC LIMIT 30""")
def q_topk_latest(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(30)


# -- stream ------------------------------------------------------------------------


def _events_stream(spark, sf_dir):
    schema = read_table(spark, sf_dir, "events").schema
    return stream_source(spark, sf_dir.rstrip("/"), schema, glob="events.parquet")


def _ingest_events(spark, sf_dir):
    sink = work_path(spark, "events-sink")
    ckpt = work_path(spark, "events-ckpt")
    run_incremental(_events_stream(spark, sf_dir), sink, ckpt,
                    query_name=f"events_ingest_{abs(hash(sink)) % 10**8}", origin="stream")
    return sink


@register("stream_ingest", f"SELECT {EVENT_COLS}, 'stream' AS origin FROM events")
def q_stream_ingest(spark, sf_dir):
    sink = _ingest_events(spark, sf_dir)
    return spark.read.parquet(sink).drop(ing.INGESTED_AT)


@register("stream_report", f"""
SELECT {EVENT_COLS}, COUNT(*) OVER () AS total_rows FROM events
QUALIFY ROW_NUMBER() OVER (ORDER BY ts DESC, event_id DESC) <= 30""")
def q_stream_report(spark, sf_dir):
    """Post-run report: latest 30 rows of the sink plus the sink total."""
    sink_df = spark.read.parquet(_ingest_events(spark, sf_dir)).drop(ing.INGESTED_AT, ing.ORIGIN)
    total = sink_df.count()
    latest = sink_df.orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(30)
    return latest.withColumn("total_rows", F.lit(total).cast("bigint"))


SPLIT_TS = "2024-01-16"


@register("stream_incremental", f"""
SELECT 1 AS run, COUNT(*) FILTER (WHERE ts < TIMESTAMP '{SPLIT_TS}') AS rows_in_sink FROM events
UNION ALL
SELECT 2, COUNT(*) FILTER (WHERE ts < TIMESTAMP '{SPLIT_TS}') FROM events
UNION ALL
SELECT 3, COUNT(*) FROM events""")
def q_stream_incremental(spark, sf_dir):
    """Exactly-once restart: run, rerun without new data, append, run again."""
    events = read_table(spark, sf_dir, "events")
    stage = work_path(spark, "events-stage")
    sink = work_path(spark, "incr-sink")
    ckpt = work_path(spark, "incr-ckpt")
    early = events.filter(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz"))
    late = events.filter(F.col("ts") >= F.lit(SPLIT_TS).cast("timestamp_ntz"))
    sinks.write_table(early, stage, mode="append")
    counts = []
    name = f"events_incremental_{abs(hash(sink)) % 10**8}"
    for run, new_data in ((1, None), (2, None), (3, late)):
        if new_data is not None:
            sinks.write_table(new_data, stage, mode="append")
        run_incremental(stream_source(spark, stage, events.schema), sink, ckpt, name)
        counts.append((run, spark.read.parquet(sink).count()))
    return spark.createDataFrame(counts, "run int, rows_in_sink bigint")
