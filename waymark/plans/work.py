"""Queries of work planning, resuming and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import scalar as S
from ..operators import planning
from ..streaming import progress
from .proxies import Proxies, sql
from .registry import query

JOB = ["scene", "actor"]


@query(sql("""WITH n AS (SELECT label, count(*) AS n, max(x) AS far FROM path_point GROUP BY 1)
SELECT a.label, CASE WHEN a.scene % 9 = 0 THEN 'missing_meta_or_labels' WHEN n.n IS NULL THEN 'label_missing' WHEN n.far < 10 THEN 'prepare_failed' WHEN n.n < 3 THEN 'below_min_frames' END AS reason FROM assignment AS a LEFT JOIN n USING (label)""", "path_point", "assignment"))
def reject_reasons(p: Proxies) -> DataFrame:
    n = p.path_point().groupBy("label").agg(F.count("*").alias("n"), F.max("x").alias("far"))
    df = p.assignment().join(n, "label", "left")
    reason = planning.first_reason(
        (F.col("scene") % 9 == 0, "missing_meta_or_labels"), (F.col("n").isNull(), "label_missing"), (F.col("far") < 10, "prepare_failed"), (F.col("n") < 3, "below_min_frames")
    )
    return df.select("label", reason.alias("reason"))


@query(sql("SELECT DISTINCT scene, label FROM (SELECT *, dense_rank() OVER (ORDER BY scene) - 1 AS r FROM path_point) WHERE r % 3 = 1", "path_point"))
def shard_filter(p: Proxies) -> DataFrame:
    return planning.shard(p.path_point().select("scene", "label").distinct(), "scene", 2, 3)


@query(sql("SELECT scene, actor_id, array_to_string(list_sort(list(label)), ',') AS labels, count(*) AS n_labels, max(ordinal) AS last_ordinal FROM assignment GROUP BY ALL", "assignment"))
def job_plans(p: Proxies) -> DataFrame:
    df = planning.job_plans(p.assignment(), ["scene", "actor_id"], "label", "ordinal")
    return df.withColumn("labels", F.array_join(F.col("labels").cast("array<string>"), ","))


@query(sql("WITH k AS (SELECT DISTINCT format('{:05d}/{:09d}', scene, actor_id) AS job FROM assignment) SELECT job, (row_number() OVER (ORDER BY job) - 1) % 12 + 1 AS slot FROM k", "assignment"))
def worker_slots(p: Proxies) -> DataFrame:
    jobs = p.assignment().select(F.format_string("%05d/%09d", F.col("scene"), F.col("actor_id")).alias("job"))
    return planning.slots(jobs, "job", 12)


@query(sql("""WITH k AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS k FROM assignment) SELECT label, k // 7 AS round, k % 7 AS "order", 'actor' || (k % 7) AS actor FROM k""", "assignment"))
def round_robin_assignment(p: Proxies) -> DataFrame:
    return planning.assign(p.assignment().select("label"), "label", [f"actor{k}" for k in range(7)])


@query(sql("""WITH k AS (SELECT row_number() OVER (ORDER BY label) - 1 AS k FROM assignment), c AS (SELECT 'actor' || (k % 7) AS actor, count(*) AS n FROM k GROUP BY 1)
SELECT actor, coalesce(n, 0) AS n FROM (SELECT 'actor' || i AS actor FROM range(9) AS t(i)) LEFT JOIN c USING (actor)""", "assignment"))
def assignment_counts(p: Proxies) -> DataFrame:
    dealt = planning.assign(p.assignment().select("label"), "label", [f"actor{k}" for k in range(7)])
    names = p.spark.range(9).select(F.concat(F.lit("actor"), F.col("id").cast("string")).alias("actor"))
    return names.join(dealt.groupBy("actor").agg(F.count("*").alias("n")), "actor", "left").select("actor", F.coalesce("n", F.lit(0)).alias("n"))


@query()
def seeded_assignment(p: Proxies) -> DataFrame:
    """Shuffles of Python's generator, which SQL cannot make; tested against them directly."""
    return planning.assign(p.assignment().select("label"), "label", [f"actor{k}" for k in range(7)], seed=33)


@query("SELECT o_orderkey AS image, (row_number() OVER (ORDER BY o_orderkey) - 1) % 8 = 0 AS is_test FROM orders")
def train_test_holdout8(p: Proxies) -> DataFrame:
    return planning.holdout(p.table("orders").select(F.col("o_orderkey").alias("image")), "image")


_STATE = "SELECT scene, actor, CASE WHEN bool_or(status = 'SUCCESS') THEN 'completed' ELSE 'failed' END AS state FROM logline GROUP BY ALL"


@query(sql(_STATE, "logline"))
def resume_state(p: Proxies) -> DataFrame:
    return planning.resume_state(p.logline(), JOB)


@query(sql(_STATE, "logline"))
def resume_from_log_lines(p: Proxies) -> DataFrame:
    """The same from log text."""
    lines = p.logline().select(F.format_string("[%s] scene=%s actor=%s labels=1 returncode=0", "status", F.col("scene").cast("string"), F.col("actor").cast("string")).alias("value"))
    log = planning.parse_log(lines)
    return planning.resume_state(log.select("status", F.col("scene").cast("long").alias("scene"), F.col("actor").cast("long").alias("actor")), JOB)


@query(sql(f"WITH s AS ({_STATE}), j AS (SELECT DISTINCT scene, actor FROM logline UNION SELECT scene, 99 FROM logline) SELECT scene, actor FROM j WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.scene = j.scene AND s.actor = j.actor AND state = 'completed')", "logline"))
def pending_jobs(p: Proxies) -> DataFrame:
    log = p.logline()
    jobs = log.select(*JOB).union(log.select("scene", F.lit(99).cast("long"))).distinct()
    return planning.pending(jobs, planning.resume_state(log, JOB), JOB)


@query("""SELECT c_name AS scene FROM customer WHERE c_name >= coalesce((SELECT min(c_name) FROM customer WHERE regexp_extract(c_name, '([1-9][0-9]*)$', 1) = '120'), '')""")
def resume_from_token(p: Proxies) -> DataFrame:
    names = p.table("customer").select(F.regexp_extract("c_name", r"([0-9]+)$", 1).alias("number"), F.col("c_name").alias("scene"))
    kept = planning.resume_from(names.select(F.col("number").alias("key")), "key", "0120")
    return names.join(kept, F.col("number") == F.col("key"), "left_semi").select("scene")


@query("SELECT DISTINCT regexp_replace(trim(v), '\\.[^.]*$', '') AS id FROM (SELECT unnest(string_split(p_name, ' ')) AS v FROM part UNION ALL SELECT unnest(string_split(c_name || '.json, #x,,' || c_mktsegment || '.png', ',')) FROM customer) WHERE trim(v) <> '' AND NOT starts_with(trim(v), '#')")
def normalise_ids(p: Proxies) -> DataFrame:
    parts = p.table("part").select(F.replace("p_name", F.lit(" "), F.lit(",")).alias("v"))
    names = p.table("customer").select(F.concat("c_name", F.lit(".json, #x,,"), "c_mktsegment", F.lit(".png")).alias("v"))
    return planning.normalise_ids(parts.union(names), "v")


@query("SELECT c_name AS name, row_number() OVER (ORDER BY CAST(regexp_extract(c_name, '([0-9]+)', 1) AS BIGINT) % 1000, CAST(regexp_extract(c_name, '([0-9]+)', 1) AS BIGINT)) - 1 AS place FROM customer")
def natural_sort_rank(p: Proxies) -> DataFrame:
    number = F.regexp_extract("c_name", "([0-9]+)", 1).cast("long")
    names = p.table("customer").select(F.col("c_name").alias("name"), F.concat(F.lit("F"), (number % 1000).cast("string"), F.lit("_"), number.cast("string")).alias("shown"))
    keyed = names.withColumn("key", S.natural_key("shown"))
    return keyed.join(planning.numbered(keyed, "key", "place"), "key").select("name", "place")


@query("SELECT c_name AS folder, CAST(regexp_extract(c_name, '([0-9]+)', 1) AS INTEGER) < 100 AS moved FROM customer")
def folder_numbers(p: Proxies) -> DataFrame:
    n = F.regexp_extract("c_name", "([0-9]+)", 1).try_cast("int")
    return p.table("customer").select(F.col("c_name").alias("folder"), F.coalesce(n < 100, F.lit(False)).alias("moved"))


@query("""SELECT c_custkey, greatest(load, used) AS usage, printf('#%02x%02x00', CAST(floor(255 * least(greatest(load, used), 100) / 100) AS BIGINT), CAST(floor(255 * (1 - least(greatest(load, used), 100) / 100)) AS BIGINT)) AS colour,
CASE WHEN c_acctbal * 1000 >= 1048576 THEN printf('%.2f MB', round(c_acctbal * 1000 / 1048576, 2)) WHEN c_acctbal * 1000 >= 1024 THEN printf('%.2f KB', round(c_acctbal * 1000 / 1024, 2)) ELSE printf('%.2f B', round(c_acctbal * 1000, 2)) END AS text
FROM (SELECT *, round(abs(c_acctbal) / 100 / 8 * 8, 6) AS load, round(CAST(c_nationkey AS DOUBLE) / 25 * 100, 2) AS used FROM customer)""")
def host_usage(p: Proxies) -> DataFrame:
    df = p.table("customer").withColumns({"load": F.round(F.abs("c_acctbal") / 100 / 8 * 8, 6), "used": F.round(F.col("c_nationkey").cast("double") / 25 * 100, 2)})
    usage = F.greatest("load", "used")
    return df.select("c_custkey", usage.alias("usage"), S.percent_colour(usage).alias("colour"), S.byte_text(F.col("c_acctbal") * 1000).alias("text"))


EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _stream(p: Proxies) -> DataFrame:
    """The events as they arrive; file streams watch folders, so the table is one name in its folder."""
    return progress.finished(p.spark, p.dir, EVENTS, pattern="events.parquet")


@query("SELECT count(*) AS jobs, CAST(sum(user_id) AS BIGINT) AS paths, round(sum(value), 6) AS seconds FROM events WHERE event_type = 'purchase'")
def stream_progress(p: Proxies) -> DataFrame:
    done = _stream(p).where("event_type = 'purchase'")
    return progress.drain(progress.progress_stream(done, F.col("user_id"), F.col("value")))


@query(sql(_STATE, "logline"))
def stream_resume(p: Proxies) -> DataFrame:
    status = F.when(F.col("event_type") == "purchase", "SUCCESS").when(F.col("event_type") == "error", "FAILED")
    log = _stream(p).select(F.col("user_id").alias("scene"), (F.floor("value") % 7).cast("long").alias("actor"), status.alias("status"))
    return progress.drain(progress.resume_stream(log, JOB))
