"""Queries over file inventories."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import inventory
from .proxies import Proxies, sql
from .registry import query


@query("""WITH b AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 100 = 0 THEN 0 ELSE 1 END AS source, c_custkey AS place FROM customer WHERE (c_custkey % 100 = 0 OR c_nationkey = 3) AND c_custkey % 7 <> 0) SELECT id, source, place FROM b""")
def actor_discovery(p: Proxies) -> DataFrame:
    all_ = p.table("customer").select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("place"), "c_nationkey")
    return inventory.discover(all_.where("id % 100 = 0"), all_.where("c_nationkey = 3"), all_.where("id % 7 = 0"), "id", "place")


_FILES = """f AS (SELECT c_nationkey AS scene, CASE c_custkey % 4 WHEN 0 THEN 'frame_' || c_custkey || '.ply' WHEN 1 THEN 'other_' || c_custkey || '.PLY' WHEN 2 THEN c_custkey || '.png' ELSE 'scene.ply' END AS name
FROM customer WHERE c_nationkey % 2 = 0 OR c_custkey % 4 <> 0)"""


def _files(p: Proxies) -> DataFrame:
    k = F.col("c_custkey").cast("string")
    kind = F.col("c_custkey") % 4
    name = F.when(kind == 0, F.concat(F.lit("frame_"), k, F.lit(".ply"))).when(kind == 1, F.concat(F.lit("other_"), k, F.lit(".PLY"))).when(kind == 2, F.concat(k, F.lit(".png"))).otherwise("scene.ply")
    return p.table("customer").where("c_nationkey % 2 = 0 or c_custkey % 4 <> 0").select(F.col("c_nationkey").alias("scene"), name.alias("name"))


@query(f"WITH {_FILES}, c AS (SELECT * FROM f WHERE lower(name) LIKE '%.ply') SELECT scene, name FROM c WHERE name LIKE 'frame_%' OR scene NOT IN (SELECT scene FROM c WHERE name LIKE 'frame_%')")
def actor_frame_files(p: Proxies) -> DataFrame:
    return inventory.frame_files(_files(p), "scene", "name", "^frame_").select("scene", "name")


@query(f"WITH {_FILES} SELECT scene, coalesce(min(name) FILTER (name = 'best.ply'), min(name) FILTER (name = 'scene.ply'), min(name)) AS name FROM f WHERE lower(name) LIKE '%.ply' GROUP BY scene")
def scene_clouds(p: Proxies) -> DataFrame:
    return inventory.scene_cloud(_files(p), "scene", "name", ["best.ply", "scene.ply"])


@query("SELECT c_nationkey AS scene, CASE WHEN bool_or(c_custkey % 90 = 0) THEN 'colmap' WHEN bool_or(c_custkey % 40 = 0) THEN 'transforms' ELSE 'unknown' END AS kind FROM customer GROUP BY 1")
def scene_kinds(p: Proxies) -> DataFrame:
    name = F.when(F.col("c_custkey") % 90 == 0, "sparse").when(F.col("c_custkey") % 40 == 0, "transforms_train.json").otherwise("x")
    return inventory.scene_kind(p.table("customer").select(F.col("c_nationkey").alias("scene"), name.alias("name")), "scene", "name")


@query("SELECT c_nationkey AS scene, CASE WHEN bool_or(c_custkey % 30 = 0) THEN 'label_paths' ELSE '' END AS folder FROM customer WHERE c_custkey % 30 = 0 OR c_custkey % 11 = 0 GROUP BY 1")
def label_folders(p: Proxies) -> DataFrame:
    folder = F.when(F.col("c_custkey") % 30 == 0, "label_paths").when(F.col("c_custkey") % 11 == 0, "").otherwise("other")
    return inventory.label_folder(p.table("customer").select(F.col("c_nationkey").alias("scene"), folder.alias("folder")), "scene", "folder")


@query("SELECT c_custkey AS name FROM customer WHERE c_custkey % 2 = 0")
def numeric_folders(p: Proxies) -> DataFrame:
    name = F.concat(F.when(F.col("c_custkey") % 2 == 1, "x").otherwise(""), F.col("c_custkey").cast("string"))
    return inventory.numeric_folders(p.table("customer").select(name.alias("name")), "name").select(F.col("name").cast("long").alias("name"))


@query("""SELECT c_custkey, round(c_acctbal / greatest(c_nationkey, 1) * 100, 6) AS cpu_pct, CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE round((1000.0::DOUBLE - c_nationkey) / 1000 * 100, 6) END AS mem_pct FROM customer""")
def host_reports(p: Proxies) -> DataFrame:
    memory = F.when(F.col("c_custkey") % 5 == 0, "none").otherwise("1000")
    text = F.concat_ws("\n", F.lit("h"), F.concat(F.col("c_acctbal").cast("string"), F.lit(" 0 0")), F.col("c_nationkey").cast("string"), memory, F.when(memory == "none", "0").otherwise(F.col("c_nationkey").cast("string")))
    df = inventory.host_status(p.table("customer").select("c_custkey", text.alias("report")), "report")
    return df.select("c_custkey", F.round("cpu_pct", 6).alias("cpu_pct"), F.round("mem_pct", 6).alias("mem_pct"))


@query(sql("SELECT pid, round(opacity, 6) AS opacity, round(s0, 6) AS scale_x, 1 AS actor, 230 AS r FROM point", "point"))
def debug_cloud(p: Proxies) -> DataFrame:
    df = p.point().withColumnsRenamed({"s0": "scale_0", "s1": "scale_1", "s2": "scale_2"})
    out = inventory.debug_vertices(df.withColumn("z", F.col("pid")), 1, 230, 80, 60)
    return out.select(F.col("z").alias("pid"), F.round("opacity", 6).alias("opacity"), F.round("scale_x", 6).alias("scale_x"), F.col("actor").cast("int").alias("actor"), F.col("r").cast("int").alias("r"))


@query("SELECT c_custkey AS image, CAST(s_nationkey AS BIGINT) AS exposure FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey")
def image_exposures(p: Proxies) -> DataFrame:
    known = p.table("supplier").select(F.col("s_suppkey").alias("image"), F.col("s_nationkey").cast("long").alias("exposure"))
    return inventory.exposures(p.table("customer").select(F.col("c_custkey").alias("image")), known, "image")
