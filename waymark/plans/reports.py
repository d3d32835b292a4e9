"""Queries of the reports: metrics, statistics, coverage, outcomes, progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import scalar as S
from ..operators import paths, stats
from ..operators.planning import last_row
from .proxies import DIGITS, Proxies, describe_sql, sql
from .registry import query

PATH = ["scene", "label"]
FRAMES = {"frames_30": 30, "frames_60": 60, "frames_90": 90}
LENGTHS = {name: n * S.STEP * 20 for name, n in FRAMES.items()}  # proxy units are 20 to the metre
LEAST = stats.bytes_of_mb(0.1)


@query(sql("SELECT scene, label, keypoints, length, displacement, round(raw / nullif(far, 0), 6) AS tortuosity, round(raw / 0.05::DOUBLE, 6) AS frames FROM metric", "metric"))
def path_metrics(p: Proxies) -> DataFrame:
    return paths.metrics(p.path_point(), PATH)


@query(sql("SELECT scene, label, count(*) FILTER (x <> 13 AND y <> 5) AS usable, 'fewer than 2 usable points' AS reason FROM (SELECT scene, label, x, round(y) AS y FROM path_point) GROUP BY ALL HAVING usable < 2", "path_point"))
def path_failures(p: Proxies) -> DataFrame:
    points = p.path_point().withColumns({"x": F.nullif("x", F.lit(13.0)), "y": F.nullif(F.round("y"), F.lit(5.0))})
    return paths.failures(points, PATH)


@query(sql(f"SELECT scene, {describe_sql('length')} FROM metric GROUP BY scene", "metric"))
def scene_describe_length(p: Proxies) -> DataFrame:
    return stats.describe(paths.metrics(p.path_point(), PATH), "length", ["scene"], digits=DIGITS)


_COUNTS = ", ".join(f"count(*) FILTER (length >= {v!r}) AS {k}" for k, v in LENGTHS.items())


@query(sql(f"SELECT scene, {_COUNTS} FROM metric GROUP BY scene", "metric"))
def scene_threshold_counts(p: Proxies) -> DataFrame:
    return stats.threshold_counts(paths.metrics(p.path_point(), PATH), F.col("length"), LENGTHS, ["scene"])


@query(sql(f"WITH c AS (SELECT scene, {_COUNTS} FROM metric GROUP BY scene), l AS (UNPIVOT c ON frames_30, frames_60, frames_90 INTO NAME threshold VALUE n) SELECT threshold, {describe_sql('n')} FROM l GROUP BY threshold", "metric"))
def threshold_detail(p: Proxies) -> DataFrame:
    counts = stats.threshold_counts(paths.metrics(p.path_point(), PATH), F.col("length"), LENGTHS, ["scene"])
    return stats.describe(counts.unpivot("scene", list(LENGTHS), "threshold", "n"), "n", ["threshold"], digits=DIGITS)


@query(sql("WITH c AS (SELECT path, count(*) AS n FROM frame GROUP BY path) SELECT count(*) FILTER (n >= 30) AS frames_30, count(*) FILTER (n >= 60) AS frames_60, count(*) FILTER (n >= 90) AS frames_90 FROM c", "frame"))
def frame_threshold_counts(p: Proxies) -> DataFrame:
    return stats.threshold_counts(p.frame().groupBy("path").agg(F.count("*").alias("n")), F.col("n"), FRAMES)


@query(sql("""WITH e AS (SELECT min(length) AS lo, max(length) AS hi FROM metric)
SELECT CAST(least(floor((length - lo) / (hi - lo) * 60) + 1, 60) AS BIGINT) AS bin, count(*) AS n FROM metric, e GROUP BY 1""", "metric"))
def length_histogram_60(p: Proxies) -> DataFrame:
    return stats.histogram(paths.metrics(p.path_point(), PATH), "length")


@query(sql("SELECT scene, label, length FROM metric ORDER BY length DESC, scene, label LIMIT 10", "metric"))
def longest_paths_10(p: Proxies) -> DataFrame:
    return paths.metrics(p.path_point(), PATH).orderBy(F.desc("length"), *PATH).limit(10).select(*PATH, "length")


@query(sql("SELECT scene, label, length FROM metric ORDER BY length, scene, label LIMIT 10", "metric"))
def shortest_paths_10(p: Proxies) -> DataFrame:
    return paths.metrics(p.path_point(), PATH).orderBy("length", *PATH).limit(10).select(*PATH, "length")


@query(sql("SELECT scene, count(*) AS n FROM assignment GROUP BY scene ORDER BY n DESC, min(ordinal), scene LIMIT 20", "assignment"))
def top_scenes_by_paths(p: Proxies) -> DataFrame:
    return stats.top_counts(p.assignment(), "scene", "ordinal")


@query(sql("SELECT actor_id, count(*) AS n FROM assignment GROUP BY actor_id ORDER BY n DESC, min(ordinal), actor_id LIMIT 20", "assignment"))
def top_actors_20(p: Proxies) -> DataFrame:
    return stats.top_counts(p.assignment(), "actor_id", "ordinal")


@query(sql("SELECT scene, count(*) AS n, round(avg(length), 4) AS mean_length FROM metric GROUP BY scene", "metric"))
def scene_count_vs_mean(p: Proxies) -> DataFrame:
    return paths.metrics(p.path_point(), PATH).groupBy("scene").agg(F.count("*").alias("n"), F.round(F.avg("length"), 4).alias("mean_length"))


@query(sql(f"SELECT {describe_sql('n')} FROM (SELECT actor_id, count(*) AS n FROM assignment GROUP BY 1)", "assignment"))
def describe_of_counts(p: Proxies) -> DataFrame:
    return stats.describe(p.assignment().groupBy("actor_id").agg(F.count("*").alias("n")), "n", digits=DIGITS)


@query(sql("SELECT kind, count(*) AS n FROM assignment LEFT JOIN actor ON actor_id = id GROUP BY kind", "assignment", "actor"))
def count_with_null_key(p: Proxies) -> DataFrame:
    return p.assignment().join(p.actor(), F.col("actor_id") == F.col("id"), "left").groupBy("kind").agg(F.count("*").alias("n"))


@query(sql(f"SELECT scene, count(*) AS n, {describe_sql('speed', 'speed_')} FROM assignment LEFT JOIN actor ON actor_id = id GROUP BY scene", "assignment", "actor"))
def actor_speed_samples_left_join(p: Proxies) -> DataFrame:
    joined = p.assignment().join(p.actor(), F.col("actor_id") == F.col("id"), "left")
    return joined.groupBy("scene").agg(F.count("*").alias("n")).join(stats.describe(joined, "speed", ["scene"], "speed_", DIGITS), "scene")


@query(sql("SELECT ordinal, actor_id FROM assignment WHERE actor_id NOT IN (SELECT id FROM actor)", "assignment", "actor"))
def missing_actor_violations(p: Proxies) -> DataFrame:
    return p.assignment().join(p.actor(), F.col("actor_id") == F.col("id"), "left_anti").select("ordinal", "actor_id")


@query(sql("SELECT ordinal, coalesce(CASE WHEN priority = '1-URGENT' THEN round(price / 1000, 6) END, speed, 0) AS foot_offset FROM assignment LEFT JOIN actor ON actor_id = id", "assignment", "actor"))
def foot_offset_override(p: Proxies) -> DataFrame:
    own = F.when(F.col("priority") == "1-URGENT", F.round(F.col("price") / 1000, 6))
    joined = p.assignment().join(p.actor(), F.col("actor_id") == F.col("id"), "left")
    return joined.select("ordinal", F.coalesce(own, "speed", F.lit(0.0)).alias("foot_offset"))


@query("""WITH e AS (SELECT n_nationkey AS scene FROM nation WHERE n_regionkey < 3), a AS (SELECT DISTINCT c_nationkey AS scene FROM customer WHERE c_nationkey % 2 = 0)
SELECT scene, 'missing' AS side FROM (SELECT * FROM e EXCEPT SELECT * FROM a) UNION ALL SELECT scene, 'extra' FROM (SELECT * FROM a EXCEPT SELECT * FROM e)""")
def scene_missing_extra(p: Proxies) -> DataFrame:
    expected = p.table("nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("scene"))
    return stats.both_differences(expected, p.table("customer").where("c_nationkey % 2 = 0").select(F.col("c_nationkey").alias("scene")), "scene")


def _coverage_sides(p: Proxies) -> tuple[DataFrame, DataFrame]:
    expected = p.table("customer").select(F.col("c_nationkey").alias("scene"), F.col("c_custkey").alias("label"))
    urgent = p.assignment().where("priority = '1-URGENT'").select("scene", F.col("actor_id").alias("label"))
    odd = p.assignment().where("ordinal % 50 = 0").select("scene", (F.col("actor_id") + 1_000_000).alias("label"))
    return expected, urgent.union(odd)


_SIDES = """WITH e AS (SELECT DISTINCT c_nationkey AS scene, c_custkey AS label FROM customer),
a AS (SELECT DISTINCT scene, actor_id AS label FROM assignment WHERE priority = '1-URGENT' UNION SELECT DISTINCT scene, actor_id + 1000000 FROM assignment WHERE ordinal % 50 = 0),
f AS (SELECT coalesce(e.scene, a.scene) AS scene, e.label AS el, a.label AS al FROM e FULL JOIN a ON e.scene = a.scene AND e.label = a.label)"""


@query(sql(_SIDES + """ SELECT scene, count(el) AS expected, count(al) AS actual, count(*) FILTER (el IS NOT NULL AND al IS NOT NULL) AS shared,
count(*) FILTER (al IS NULL) AS missing, count(*) FILTER (el IS NULL) AS extra,
round(coalesce(count(*) FILTER (el IS NOT NULL AND al IS NOT NULL)::DOUBLE / nullif(count(el), 0), 1), 6) AS ratio FROM f GROUP BY scene""", "assignment"))
def label_coverage_by_scene(p: Proxies) -> DataFrame:
    return stats.coverage(*_coverage_sides(p), "scene", "label")


@query(sql(_SIDES + """ SELECT count(el) AS expected, count(al) AS actual, count(*) FILTER (al IS NULL) AS missing, count(*) FILTER (el IS NULL) AS extra FROM f""", "assignment"))
def coverage_totals(p: Proxies) -> DataFrame:
    return stats.coverage(*_coverage_sides(p), "scene", "label").agg(*(F.sum(c).alias(c) for c in ("expected", "actual", "missing", "extra")))


@query(sql(_SIDES + """ SELECT scene, string_agg(el::VARCHAR, ',' ORDER BY el) AS items FROM (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY el) AS r FROM f WHERE al IS NULL) WHERE r <= 25 GROUP BY scene""", "assignment"))
def coverage_missing_samples(p: Proxies) -> DataFrame:
    return stats.difference_samples(*_coverage_sides(p), "scene", "label", 25)


@query(sql(_SIDES + f""" SELECT {describe_sql('ratio')} FROM (SELECT scene, count(*) FILTER (el IS NOT NULL AND al IS NOT NULL)::DOUBLE / count(el) AS raw, round(raw, 6) AS ratio FROM f GROUP BY scene)""", "assignment"))
def coverage_ratio_describe(p: Proxies) -> DataFrame:
    df = stats.coverage(*_coverage_sides(p), "scene", "label").withColumn("ratio", F.round(F.col("shared").cast("double") / F.col("expected"), 6))
    return stats.describe(df, "ratio", digits=DIGITS)


def _outcomes(p: Proxies) -> DataFrame:
    return p.assignment().join(p.inventory(), "label", "left").withColumn("outcome", stats.outcome(F.col("size"), LEAST))


_OUTCOME = f"o AS (SELECT a.*, size, CASE WHEN size IS NULL THEN 'skipped' WHEN size >= {LEAST} THEN 'success' ELSE 'failed' END AS outcome FROM assignment AS a LEFT JOIN inventory USING (label))"
_OUTCOMES = "count(*) AS expected, " + ", ".join(f"count(*) FILTER (outcome = '{o}') AS {o}" for o in stats.OUTCOMES)


@query(sql(f"WITH {_OUTCOME} SELECT scene, label, actor_id, outcome FROM o", "assignment", "inventory"))
def video_outcome_rows(p: Proxies) -> DataFrame:
    return _outcomes(p).select("scene", "label", "actor_id", "outcome")


@query(sql(f"WITH {_OUTCOME} SELECT scene, {_OUTCOMES} FROM o GROUP BY scene", "assignment", "inventory"))
def outcome_by_scene(p: Proxies) -> DataFrame:
    return stats.outcome_counts(_outcomes(p), ["scene"])


@query(sql(f"WITH {_OUTCOME} SELECT actor_id, {_OUTCOMES} FROM o GROUP BY actor_id", "assignment", "inventory"))
def outcome_by_actor(p: Proxies) -> DataFrame:
    return stats.outcome_counts(_outcomes(p), ["actor_id"])


@query(sql(f"WITH {_OUTCOME} SELECT scene, actor_id, {_OUTCOMES} FROM o GROUP BY GROUPING SETS ((scene), (actor_id))", "assignment", "inventory"))
def outcome_grouping_sets(p: Proxies) -> DataFrame:
    sets = _outcomes(p).groupingSets([["scene"], ["actor_id"]], "scene", "actor_id")
    return sets.agg(F.count("*").alias("expected"), *(F.count_if(F.col("outcome") == o).alias(o) for o in stats.OUTCOMES))


@query(sql(f"""WITH last AS (SELECT scene, label, arg_max(actor_id, ordinal) AS actor_id FROM assignment GROUP BY ALL),
f AS (SELECT a.scene, a.label, last.actor_id, list_filter([CASE WHEN size IS NULL THEN 'missing_video' WHEN size < {LEAST} THEN 'small_video' END,
 CASE WHEN frames IS NULL THEN 'frames_dir_missing' END, CASE WHEN depth < frames THEN 'missing_depth' END, CASE WHEN rgb < frames THEN 'missing_rgb' END], lambda v: v IS NOT NULL) AS flags
FROM assignment AS a LEFT JOIN inventory USING (label) LEFT JOIN last ON last.scene = a.scene AND last.label = a.label)
SELECT scene, label, actor_id, array_to_string(flags, ',') AS flags FROM f WHERE len(flags) > 0""", "assignment", "inventory"))
def qa_flags(p: Proxies) -> DataFrame:
    owner = last_row(p.assignment().select("scene", "label", "actor_id", "ordinal"), PATH, "ordinal").select(*PATH, "actor_id")
    df = p.assignment().select(*PATH).join(p.inventory(), "label", "left").join(owner, PATH, "left")
    found = stats.flags(
        (F.col("size").isNull(), "missing_video"),
        (F.col("size") < LEAST, "small_video"),
        (F.col("frames").isNull(), "frames_dir_missing"),
        (F.col("depth") < F.col("frames"), "missing_depth"),
        (F.col("rgb") < F.col("frames"), "missing_rgb"),
    )
    return df.withColumn("flags", found).where(F.size("flags") > 0).select(*PATH, "actor_id", F.array_join("flags", ",").alias("flags"))


@query("SELECT l_returnflag AS stage, round(sum(l_quantity), 6) AS seconds, round(sum(l_quantity) / (SELECT sum(l_quantity) FROM lineitem), 6) AS ratio FROM lineitem GROUP BY 1")
def stage_ratio(p: Proxies) -> DataFrame:
    df = p.table("lineitem").select(F.col("l_returnflag").alias("stage"), F.col("l_quantity").alias("sec"))
    return stats.stage_ratios(df, "stage", "sec")


@query("""SELECT count(*) AS jobs, sum(n) AS paths, round(sum(sec), 6) AS seconds, round(sum(n) / 1000000.0::DOUBLE, 6) AS share, round(sum(sec) / sum(n), 6) AS mean_seconds,
round(sum(sec) / sum(n) * greatest(1000000 - sum(n), 0), 6) AS eta_seconds FROM (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS sec FROM lineitem GROUP BY 1)""".replace("sum(n) AS paths", "CAST(sum(n) AS BIGINT) AS paths"))
def progress_snapshot(p: Proxies) -> DataFrame:
    jobs = p.table("lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("sec"))
    return stats.progress(jobs, 1_000_000, F.col("n"), F.col("sec"))


@query("""WITH s AS (SELECT l_orderkey, l_returnflag, sum(l_quantity) AS sec FROM lineitem GROUP BY ALL), t AS (SELECT l_orderkey, sum(sec) AS total FROM s GROUP BY 1)
SELECT l_orderkey AS path, l_returnflag AS stage, round(sec, 6) AS seconds, round(sec / nullif(total, 0), 6) AS ratio FROM s JOIN t USING (l_orderkey)""")
def path_stage_ratio(p: Proxies) -> DataFrame:
    """Ratios from one map for each path, as run metrics keep them."""
    df = p.table("lineitem").groupBy(F.col("l_orderkey").alias("path"), F.col("l_returnflag").alias("stage")).agg(F.sum("l_quantity").alias("sec"))
    df = df.groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("stage", "sec"))).alias("m"))
    df = df.withColumn("total", F.aggregate(F.map_values("m"), F.lit(0.0), lambda a, v: a + v))
    df = df.select("path", "total", F.explode("m").alias("stage", "sec"))
    return df.select("path", "stage", F.round("sec", 6).alias("seconds"), F.round(F.try_divide("sec", F.nullif("total", F.lit(0.0))), 6).alias("ratio"))
