"""Queries that write tables through the sinks and read them back through the sources.

Every run writes to a folder of its own below the shared folder; the SQL says what
must come back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from .. import tables
from ..functions import scalar as S
from ..operators import cameras, imaging, inventory, paths, planning
from ..sources import clouds, documents, sinks
from ..streaming import progress
from .proxies import Proxies, sql
from .registry import query


def _folder(p: Proxies) -> str:
    return f"{tables.shared_dir(p.spark)}/stored/{uuid.uuid4().hex}"


def _number(file: str | Column) -> Column:
    """The number at the end of a file's stem."""
    return F.regexp_extract(S.stem(file), r"(\d+)$", 1).cast("long")


# Point clouds


def _cloud_files(p: Proxies, df: DataFrame, columns: dict[str, str]) -> str:
    """Each cloud of ``df`` as a PLY file cloud_k.ply; ``columns`` are its properties with NumPy types."""
    import numpy as np
    import pyarrow as pa

    def of(batches):
        for b in batches:
            for cloud, rows in zip(b.column("cloud").to_pylist(), b.column("rows").to_pylist()):
                data = {c: np.array([r[c] for r in rows]).astype(t) for c, t in columns.items()}
                yield pa.record_batch([pa.array([f"cloud_{cloud}.ply"]), pa.array([clouds.ply_bytes(data)])], names=["name", "content"])

    folder = _folder(p)
    # A PLY file is one cloud in one piece, and so is its row here.
    packed = df.groupBy("cloud").agg(F.array_sort(F.collect_list(F.struct("pid", *(c for c in columns if c != "pid")))).alias("rows"))
    sinks.write_files(packed.mapInArrow(of, "name string, content binary"), folder)
    return folder


@query(sql("SELECT cloud, pid, round(x::FLOAT, 4) AS x, round(y::FLOAT, 4) AS y, round(z::FLOAT, 4) AS z FROM point", "point"))
def ply_written_and_read(p: Proxies) -> DataFrame:
    """Simple clouds through PLY files and the PLY data source."""
    folder = _cloud_files(p, p.point().select("cloud", "pid", "x", "y", "z"), {"pid": "i4", "x": "f4", "y": "f4", "z": "f4"})
    p.spark.dataSource.register(clouds.PlySource)
    df = p.spark.read.format("ply").option("path", f"{folder}/*.ply").load()
    return df.select(_number("file").cast("int").alias("cloud"), F.col("pid").cast("long").alias("pid"), *(F.round(c, 4).alias(c) for c in "xyz"))


@query(sql("SELECT cloud, pid, round(x::FLOAT, 4) AS x, 0.5::DOUBLE AS red FROM point", "point"))
def simple_cloud_rows(p: Proxies) -> DataFrame:
    """Positions and colours as shares, read from any store."""
    df = p.point().select("cloud", "pid", "x", F.lit(127.5).cast("int").alias("red"))
    folder = _cloud_files(p, df, {"pid": "i4", "x": "f4", "red": "u1"})
    rows = clouds.ply_rows(p.spark, f"{folder}/*.ply", "pid int, x float, red smallint")
    return rows.select(_number("file").cast("int").alias("cloud"), F.col("pid").cast("long").alias("pid"), F.round("x", 4).alias("x"), F.round(F.col("red") / 255, 2).alias("red"))


@query(sql("SELECT pid, round(x::FLOAT, 4) AS rest_2, round(y::FLOAT, 4) AS rest_10, round(s1::FLOAT, 4) AS scale_1, round(w::FLOAT, 4) AS rot_0, round(opacity::FLOAT, 4) AS opacity FROM point", "point"))
def gaussian_attributes(p: Proxies) -> DataFrame:
    """Families of numbered properties come back in order of their numbers: 2 before 10."""
    names = {"f_rest_10": "y", "f_rest_2": "x", "scale_0": "s0", "scale_1": "s1", "scale_2": "s2", "rot_0": "w", "opacity": "opacity"}
    df = p.point().select("cloud", "pid", *(F.col(c).alias(n) for n, c in names.items()))
    folder = _cloud_files(p, df, {"pid": "i4"} | dict.fromkeys(names, "f4"))
    rows = clouds.ply_rows(p.spark, f"{folder}/*.ply", ", ".join(["pid int", *(f"{n} float" for n in names)]))
    g = clouds.gaussians(rows.withColumn("i", F.col("pid").cast("long")))
    pick = {"rest_2": F.get("f_rest", 0), "rest_10": F.get("f_rest", 1), "scale_1": F.get("scale", 1), "rot_0": F.get("rot", 0), "opacity": F.col("opacity")}
    return g.select(F.col("i").alias("pid"), *(F.round(c, 4).alias(n) for n, c in pick.items()))


# Camera models


def _model(p: Proxies) -> dict[str, DataFrame]:
    """A model made of suppliers (cameras and images), parts (points) and lineitems (what was seen)."""
    s, key = p.table("supplier"), F.col("s_suppkey")
    d = lambda x: F.col(x).cast("double")
    cam = s.select(key.alias("camera_id"), F.lit("PINHOLE").alias("model"), (key + 640).alias("width"), (key + 480).alias("height"), F.array(d("s_suppkey"), d("s_acctbal"), F.lit(320.0), F.lit(240.0)).alias("params"))
    seen = p.table("lineitem").groupBy("l_suppkey").agg(F.array_sort(F.collect_list(F.struct("l_partkey", F.col("l_quantity").alias("x"), (F.col("l_linenumber") * 1.0).alias("y")))).alias("seen"))
    img = s.join(seen, key == F.col("l_suppkey"), "left").select(
        key.alias("image_id"), F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(0.0)).alias("qvec"), F.array(d("s_acctbal"), F.lit(2.0), F.lit(3.0)).alias("tvec"), key.alias("camera_id"), F.concat("s_name", F.lit(".png")).alias("name"),
        F.coalesce(F.transform("seen", lambda q: F.struct(q["x"].cast("double").alias("x"), q["y"].cast("double").alias("y"))), F.array().cast("array<struct<x:double,y:double>>")).alias("xys"),
        F.coalesce(F.transform("seen", lambda q: q["l_partkey"]), F.array().cast("array<bigint>")).alias("point3d_ids"),
    )
    part = F.col("p_partkey")
    pts = p.table("part").select(
        part.alias("point3d_id"), F.array(d("p_retailprice"), d("p_size"), F.lit(-1.5)).alias("xyz"), F.array((part % 256).cast("int"), F.lit(0), F.lit(255)).alias("rgb"), d("p_size").alias("error"),
        F.array(part % 7, part % 11).alias("image_ids"), F.array(F.lit(0).cast("long"), F.lit(1).cast("long")).alias("point2d_idxs"),
    )
    return {"cameras": cam, "images": img, "points3D": pts}


_TEXT = {"cameras": sinks.colmap_text_cameras, "images": sinks.colmap_text_images, "points3D": sinks.colmap_text_points}


def _through(p: Proxies, table: str) -> DataFrame:
    """The table read back from the binary file and from the text file, one after the other."""
    rows = _model(p)[table]
    binary, text = _folder(p), _folder(p)
    sinks.write_colmap(rows, binary, table)
    sinks.write_document(_TEXT[table](rows), f"{text}/{table}.txt")
    return clouds.colmap(p.spark, binary, table).withColumn("form", F.lit("bin")).union(clouds.colmap(p.spark, text, table).withColumn("form", F.lit("txt")))


@query("SELECT form, s_suppkey AS camera_id, 'PINHOLE' AS model, s_suppkey + 640 AS width, s_suppkey + 480 AS height, s_acctbal AS fy FROM supplier, (SELECT unnest(['bin', 'txt']) AS form)")
def colmap_cameras(p: Proxies) -> DataFrame:
    return _through(p, "cameras").select("form", "camera_id", "model", "width", "height", F.get("params", 1).alias("fy"))


@query("""SELECT form, s_suppkey AS image_id, s_name || '.png' AS name, s_acctbal AS tx, s_suppkey AS camera_id, coalesce(n, 0) AS seen, coalesce(x, 0) AS x, CAST(coalesce(k, 0) AS BIGINT) AS keys
FROM supplier LEFT JOIN (SELECT l_suppkey, count(*) AS n, round(sum(l_quantity), 4) AS x, sum(l_partkey) AS k FROM lineitem GROUP BY 1) ON l_suppkey = s_suppkey, (SELECT unnest(['bin', 'txt']) AS form)""")
def colmap_images(p: Proxies) -> DataFrame:
    total = lambda c, f, z: F.aggregate(c, z, lambda a, v: a + f(v))
    x, keys = total("xys", lambda q: q["x"], F.lit(0.0)), total("point3d_ids", lambda k: k, F.lit(0).cast("long"))
    return _through(p, "images").select("form", "image_id", "name", F.get("tvec", 0).alias("tx"), "camera_id", F.size("xys").cast("long").alias("seen"), F.round(x, 4).alias("x"), keys.alias("keys"))


@query("SELECT form, p_partkey AS point_id, p_retailprice AS x, CAST(p_partkey % 256 AS INTEGER) AS red, p_partkey % 7 AS first_image, p_partkey % 11 AS second_image FROM part, (SELECT unnest(['bin', 'txt']) AS form)")
def colmap_points(p: Proxies) -> DataFrame:
    return _through(p, "points3D").select("form", F.col("point3d_id").alias("point_id"), F.get("xyz", 0).alias("x"), F.get("rgb", 0).alias("red"), F.get("image_ids", 0).alias("first_image"), F.get("image_ids", 1).alias("second_image"))


@query("SELECT r_regionkey AS map, y, x, r_regionkey * 100 + y * 10 + x AS value FROM region, (SELECT unnest(range(3)) AS y), (SELECT unnest(range(4)) AS x)")
def dense_maps(p: Proxies) -> DataFrame:
    """Dense arrays: a text header, then floats in column order."""
    import pyarrow as pa
    import numpy as np

    def of(batches):
        for b in batches:
            files = []
            for k in b.column(0).to_pylist():
                cells = k * 100 + np.arange(3)[:, None] * 10 + np.arange(4)
                files.append(b"4&3&1&" + cells.T.astype("<f4").tobytes(order="F"))
            yield pa.record_batch([pa.array([f"map_{k}.bin" for k in b.column(0).to_pylist()]), pa.array(files, pa.binary())], names=["name", "content"])

    folder = _folder(p)
    sinks.write_files(p.table("region").select("r_regionkey").mapInArrow(of, "name string, content binary"), folder)
    return clouds.dense_rows(p.spark, f"{folder}/*.bin").select(_number("file").cast("int").alias("map"), "y", "x", F.col("value").cast("int").alias("value"))


@query("SELECT r_regionkey AS buffer, i, r_regionkey * 10.0::DOUBLE + i AS first FROM region, (SELECT unnest(range(4)) AS i) WHERE r_regionkey * 10 + i <> 0")
def pose_buffers(p: Proxies) -> DataFrame:
    """Pose buffers as .npy files; poses of zeros are left out."""
    import io

    import numpy as np
    import pyarrow as pa

    def of(batches):
        for b in batches:
            files = []
            for k in b.column(0).to_pylist():
                out = io.BytesIO()
                np.save(out, np.stack([np.full((3, 4), k * 10.0 + i) for i in range(4)]))
                files.append(out.getvalue())
            yield pa.record_batch([pa.array([f"pose_{k}.npy" for k in b.column(0).to_pylist()]), pa.array(files, pa.binary())], names=["name", "content"])

    folder = _folder(p)
    sinks.write_files(p.table("region").select("r_regionkey").mapInArrow(of, "name string, content binary"), folder)
    return clouds.poses(p.spark, f"{folder}/*.npy").select(_number("file").cast("int").alias("buffer"), "i", F.get(F.get("pose", 0), 0).alias("first"))


# Documents


def _written(p: Proxies, rows: DataFrame, name: Column, document: Column) -> str:
    """A file of one document for each row."""
    folder = _folder(p)
    sinks.write_files(rows.select(name.alias("name"), F.encode(document, "UTF-8").alias("content")), folder)
    return folder


@query("""SELECT 'scene' || r_regionkey AS scene, n_nationkey AS label, CAST(n_nationkey AS DOUBLE) AS path_length, CASE WHEN n_nationkey % 5 = 1 THEN 'malformed document' WHEN n_nationkey % 5 = 2 THEN 'fewer than 2 usable points' END AS reason
FROM nation JOIN region ON r_regionkey = n_regionkey""")
def path_documents_back(p: Proxies) -> DataFrame:
    """Path documents of all scenes: metrics of the good ones, a reason for the others."""
    n = F.col("n_nationkey")
    point = lambda x: F.struct(F.lit(x).cast("double").alias("x") if not isinstance(x, Column) else x.cast("double").alias("x"), F.lit(0.0).alias("y"))
    body = F.to_json(F.struct(F.struct(F.when(n % 5 == 2, F.array(point(0))).otherwise(F.array(point(0), point(n))).alias("keypoints_world")).alias("path"), F.struct(F.col("n_name").alias("label")).alias("label")))
    text = F.when(n % 5 == 1, F.lit("{broken")).otherwise(body)
    folder = _written(p, p.table("nation"), F.format_string("scene%s/label_paths/%s.json", F.col("n_regionkey").cast("string"), n.cast("string")), text)
    good, bad = documents.path_documents(p.spark, f"{folder}/*/label_paths/*.json")
    found = documents.path_metrics(good).select("scene", F.col("label_stem").cast("int").alias("label"), "path_length", F.lit(None).cast("string").alias("reason"))
    failed = bad.select("scene", F.col("label_stem").cast("int").alias("label"), F.col("label_stem").cast("double").alias("path_length"), "reason")
    return found.unionByName(failed)


@query("""SELECT 'scene' || n_regionkey AS scene, n_nationkey AS label, i, CASE WHEN n_nationkey % 5 <> 3 THEN n_nationkey + i END AS x, CASE WHEN n_nationkey % 5 <> 3 THEN 7 * i END AS u,
CASE WHEN n_nationkey % 5 = 3 THEN 'raster_world and raster_pixel differ in length' END AS reason FROM (SELECT *, unnest(CASE WHEN n_nationkey % 5 = 3 THEN [NULL] ELSE range(3) END) AS i FROM nation)""")
def raster_documents(p: Proxies) -> DataFrame:
    n = F.col("n_nationkey")
    world = F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: F.struct((n + i).cast("double").alias("x"), F.lit(1.0).alias("y")))
    pixel = F.transform(F.sequence(F.lit(0), F.when(n % 5 == 3, 1).otherwise(2)), lambda i: F.array((7 * i).cast("int"), F.lit(0)))
    folder = _written(p, p.table("nation"), F.format_string("scene%s/%s.json", F.col("n_regionkey").cast("string"), n.cast("string")), F.to_json(F.struct(F.struct(world.alias("raster_world"), pixel.alias("raster_pixel")).alias("path"))))
    df = documents.raster_points(p.spark, f"{folder}/*/*.json")
    return df.select("scene", F.col("label_stem").cast("int").alias("label"), F.col("i").cast("long").alias("i"), F.col("x").cast("long").alias("x"), F.col("u").cast("long").alias("u"), "reason")


@query(sql("SELECT CAST(scene AS VARCHAR) AS scene, count(*) AS labels, sum(frames) AS frames FROM (SELECT scene, label, count(*) AS frames FROM plan GROUP BY ALL) GROUP BY scene", "plan"))
def follow_documents_back(p: Proxies) -> DataFrame:
    """Frame plans written as metadata by scene and read back: labels and frames of each scene."""
    from ..operators import frames

    plan = frames.follow_plan(p.path_point(), ["scene", "label"], 15.0).groupBy("scene", "label").agg(F.array_sort(F.collect_list(F.struct(F.col("frame").cast("int").alias("id"), F.array(F.col("person"), F.lit(0.0)).alias("person_world")))).alias("frames"))
    folder = _folder(p)
    sinks.follow_metadata(plan.withColumn("label", F.col("label").cast("string")).withColumn("follow_distance", F.lit(15.0)), folder)
    back = p.spark.read.schema("label STRING, follow_distance DOUBLE, frames ARRAY<STRUCT<id:INT,person_world:ARRAY<DOUBLE>>>, scene STRING").json(folder)
    return back.groupBy("scene").agg(F.count("*").alias("labels"), F.sum(F.size("frames")).alias("frames"))


@query("SELECT 'scene' || n_regionkey AS scene, CAST(n_nationkey AS VARCHAR) AS label, n_nationkey * 1.0::DOUBLE AS follow_distance, n_nationkey % 4 AS frame_count, CAST((n_nationkey % 4 + 1) // 2 AS INTEGER) AS persons FROM nation")
def follow_metadata_files(p: Proxies) -> DataFrame:
    """Metadata files of rendered paths: scene from the folder, label from the name, persons without numbers left out."""
    n = F.col("n_nationkey")
    frames = F.transform(F.slice(F.array(*(F.lit(k) for k in range(4))), F.lit(1), n % 4), lambda k: F.struct(k.alias("id"), F.when(k % 2 == 0, F.array(F.lit(1.0), F.lit(2.0))).otherwise(F.array(F.lit(1.0))).alias("person_world")))
    folder = _written(p, p.table("nation"), F.format_string("scene%s/%s_follow_path.json", F.col("n_regionkey").cast("string"), n.cast("string")), F.to_json(F.struct((n * 1.0).alias("follow_distance"), frames.alias("frames"))))
    df = documents.follow_documents(p.spark, f"{folder}/*/*_follow_path.json")
    return df.select("scene", "label", "follow_distance", "frame_count", F.size("persons").alias("persons"))


@query("SELECT 'scene' || n_regionkey AS scene, '.json' AS suffix, count(*) AS files, list_sort(list(CAST(n_nationkey AS VARCHAR)))[1] AS first, CAST(sum(length(n_name)) AS BIGINT) AS size FROM nation GROUP BY n_regionkey")
def file_counts(p: Proxies) -> DataFrame:
    """Expected labels and file counts of each scene, from what lies in its folder."""
    folder = _written(p, p.table("nation"), F.format_string("scene%s/%s.json", F.col("n_regionkey").cast("string"), F.col("n_nationkey").cast("string")), F.col("n_name"))
    files = documents.inventory(p.spark, folder)
    return files.groupBy("scene", "suffix").agg(F.count("*").alias("files"), F.min("stem").alias("first"), F.sum("size").alias("size"))


@query("SELECT DISTINCT CAST(c_nationkey AS VARCHAR) AS id FROM customer WHERE c_nationkey <> 3")
def ban_list(p: Proxies) -> DataFrame:
    """Ids of a text file: spaces, blank lines, comments and repeats are left out."""
    folder = _folder(p)
    key = F.col("c_nationkey").cast("string")
    sinks.write_lines(p.table("customer").select(F.when(F.col("c_nationkey") == 3, F.concat(F.lit("#"), key)).otherwise(F.concat(F.lit("  "), key, F.lit(" "))).alias("value")).union(p.spark.createDataFrame([("",)], "value string")), folder)
    return documents.id_list(p.spark, folder)


@query(sql("SELECT ordinal, CAST(scene AS VARCHAR) AS scene, CAST(label AS VARCHAR) AS label, 'actor' || (k % 7) AS actor_id, CAST(k // 7 AS INTEGER) AS round FROM (SELECT scene, label, row_number() OVER (ORDER BY label) - 1 AS k, row_number() OVER (ORDER BY label) - 1 AS ordinal FROM assignment)", "assignment"))
def manifest_back(p: Proxies) -> DataFrame:
    """The manifest written as one document and read back, assignments in their order."""
    actors = [f"actor{k}" for k in range(7)]
    labels = p.assignment().select(F.col("scene").cast("string").alias("scene"), "label")
    dealt = planning.assign(labels.select("label"), "label", actors)
    rows = dealt.join(labels, "label").select("scene", F.col("label").cast("string").alias("label"), F.col("actor").alias("actor_id"), "round", F.col("order").alias("order_index"))
    path = f"{_folder(p)}/manifest.json"
    sinks.write_document(sinks.manifest(rows, p.spark.createDataFrame([(a,) for a in actors], "id string"), 33, labels), path)
    assignments, _ = documents.manifest(p.spark, path)
    return assignments.select(F.col("ordinal").cast("long").alias("ordinal"), "scene", "label", "actor_id", "round")


@query("SELECT CAST(n_nationkey AS VARCHAR) AS label_id, n_nationkey * 10 AS frames, n_nationkey * 2.0::DOUBLE AS render FROM nation")
def run_metrics_back(p: Proxies) -> DataFrame:
    """Metrics of jobs, one document for each; empty and broken ones give no rows."""
    entry = F.struct(F.col("n_nationkey").cast("string").alias("label_id"), (F.col("n_nationkey") * 10).alias("frames"), F.create_map(F.lit("render"), F.col("n_nationkey") * 2.0).alias("stage_seconds"))
    jobs = p.table("nation").groupBy("n_regionkey").agg(F.collect_list(entry).alias("paths")).select(F.format_string("job_%s.json", F.col("n_regionkey").cast("string")).alias("name"), F.to_json(F.struct(F.lit("j").alias("job_name"), "paths")).alias("text"))
    odd = p.spark.createDataFrame([("empty.json", ""), ("broken.json", "{no")], "name string, text string")
    folder = _written(p, jobs.union(odd), F.col("name"), F.col("text"))
    return documents.run_metrics(p.spark, f"{folder}/*.json").select("label_id", "frames", F.col("stage_seconds")["render"].alias("render"))


@query("SELECT 'scene' || n_nationkey AS scene, n_nationkey * 0.5::DOUBLE AS \"left\", (100 + n_nationkey) * 0.25::DOUBLE + n_nationkey * 0.5::DOUBLE AS \"right\", 9.0::DOUBLE - (50 + n_nationkey) * 0.25 AS bottom, 100 + n_nationkey AS width, n_nationkey % 3 AS lower_z FROM nation")
def occupancy_bounds(p: Proxies) -> DataFrame:
    """World bounds of scenes, from their metadata and the sizes in the headers of their maps."""
    n = F.col("n_nationkey")
    text = F.to_json(F.struct(F.lit(0.25).alias("scale"), F.array(n * 0.5, F.lit(0.0), (n % 3).cast("double")).alias("min"), F.array(F.lit(1.0), F.lit(9.0), F.lit(3.0)).alias("max")))
    folder = _written(p, p.table("nation"), F.format_string("scene%s/occupancy.json", n.cast("string")), text)
    four = lambda v: F.unhex(F.lpad(F.hex(v), 8, "0"))
    head = F.concat(F.unhex(F.lit("89504E470D0A1A0A0000000D49484452")), four(100 + n), four(50 + n), F.unhex(F.lit("0802000000")))
    sinks.write_files(p.table("nation").select(F.format_string("scene%s/occupancy.png", n.cast("string")).alias("name"), head.alias("content")), folder)
    sizes = documents.png_sizes(p.spark, f"{folder}/*/*.png").select(F.element_at(F.split("path", "/"), -2).alias("scene"), "width", "height")
    df = documents.occupancy(p.spark, f"{folder}/*/*.json", sizes)
    return df.select("scene", "left", "right", "bottom", "width", F.col("lower_z").cast("int").alias("lower_z"))


@query("SELECT s_name AS image_name, s_acctbal AS scale, s_suppkey * 1.0::DOUBLE AS \"offset\" FROM supplier")
def depth_parameters_back(p: Proxies) -> DataFrame:
    path = f"{_folder(p)}/depth_params.json"
    rows = p.table("supplier").select(F.col("s_name").alias("image_name"), F.col("s_acctbal").alias("scale"), (F.col("s_suppkey") * 1.0).alias("offset"))
    sinks.write_document(sinks.depth_parameters(rows), path)
    return documents.depth_calibration(p.spark, path)


# Reports


@query("SELECT 'kinds' AS section, c_mktsegment AS name, count(*) AS n FROM customer GROUP BY 2 UNION ALL SELECT 'nations', CAST(c_nationkey AS VARCHAR), count(*) FROM customer GROUP BY 2")
def report_back(p: Proxies) -> DataFrame:
    """A report of summaries as one JSON document, read back by section."""
    c = p.table("customer")
    sections = {"kinds": c.groupBy(F.col("c_mktsegment").alias("name")).agg(F.count("*").alias("n")), "nations": c.groupBy(F.col("c_nationkey").cast("string").alias("name")).agg(F.count("*").alias("n"))}
    folder = _folder(p)
    sinks.write_report(sections, folder)
    kind = "array<struct<name:string,n:bigint>>"
    back = p.spark.read.text(folder, wholetext=True).select(F.from_json("value", f"kinds {kind}, nations {kind}").alias("d"))
    out = [back.select(F.lit(s).alias("section"), F.inline(f"d.{s}")) for s in sections]
    return out[0].union(out[1])


@query(sql("SELECT CAST(cloud AS VARCHAR) AS scene, 'm' || (pid % 3) AS method, round(avg(x), 6) AS psnr, round(avg(y), 6) AS ssim FROM point GROUP BY ALL", "point"))
def quality_results_back(p: Proxies) -> DataFrame:
    rows = p.point().select(F.col("cloud").cast("string").alias("scene"), F.concat(F.lit("m"), (F.col("pid") % 3).cast("string")).alias("method"), F.col("x").alias("PSNR"), F.col("y").alias("SSIM"))
    folder = _folder(p)
    sinks.write_lines(sinks.quality_results(rows), folder)
    back = p.spark.read.text(folder).select(F.explode(F.from_json("value", "map<string,map<string,struct<PSNR:double,SSIM:double>>>")).alias("scene", "m"))
    back = back.select("scene", F.explode("m").alias("method", "q"))
    return back.select("scene", "method", F.round("q.PSNR", 6).alias("psnr"), F.round("q.SSIM", 6).alias("ssim"))


@query("SELECT s_suppkey AS id, s_name AS img_name, s_acctbal AS fx FROM supplier")
def camera_documents_back(p: Proxies) -> DataFrame:
    folder = _folder(p)
    sinks.write_lines(sinks.camera_documents(p.table("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("img_name"), F.col("s_acctbal").alias("fx"))), folder)
    return p.spark.read.schema("id bigint, img_name string, fx double").json(folder)


@query("SELECT o_orderkey AS job, 'failed' AS error FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, 'late' FROM orders WHERE o_orderstatus = 'P'")
def error_log(p: Proxies) -> DataFrame:
    """Errors of two runs, appended one after the other."""
    folder = _folder(p)
    for status, text in (("F", "failed"), ("P", "late")):
        sinks.append_errors(p.table("orders").where(F.col("o_orderstatus") == status).select(F.col("o_orderkey").alias("job"), F.lit(text).alias("error")), folder)
    return p.spark.read.schema("job bigint, error string, at timestamp").parquet(folder).select("job", "error")


@query(sql("""SELECT scene, actor_id, 'python render.py --scene ' || scene || ' --actor ' || actor_id || ' --labels ' || labels || ' --follow-distance 1.500000' AS command
FROM (SELECT scene, actor_id, array_to_string(list_sort(list(label)), ',') AS labels FROM assignment GROUP BY scene, actor_id)""", "assignment"))
def command_lines(p: Proxies) -> DataFrame:
    plans = planning.job_plans(p.assignment(), ["scene", "actor_id"], "label", "ordinal")
    return sinks.command_lines(plans, "render.py", 1.5).select("scene", "actor_id", "command")


# Streams

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _arriving(p: Proxies, files: int = 1) -> DataFrame:
    """The events as a stream of several files, at most ``files`` in a batch."""
    folder = _folder(p)
    p.table("events").repartition(3, "event_id").write.parquet(folder)
    return progress.finished(p.spark, folder, EVENTS, files=files)


@query("SELECT event_type, count(*) AS jobs, CAST(sum(user_id) AS BIGINT) AS users FROM events GROUP BY 1")
def stream_limited_batches(p: Proxies) -> DataFrame:
    """One file a batch: the source holds back what the sink has not taken."""
    return progress.drain(_arriving(p).groupBy("event_type").agg(F.count("*").alias("jobs"), F.sum("user_id").alias("users")))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, count(*) AS jobs, round(sum(value), 4) AS seconds FROM events GROUP BY 1")
def stream_windows(p: Proxies) -> DataFrame:
    """Jobs of each hour of event time, under a watermark that lets all of the table's disorder in."""
    done = _arriving(p, 1000).withColumn("at", F.col("ts").cast("timestamp"))
    out = progress.drain(progress.windowed_progress(done, "at", "3650 days", "1 hour", F.col("value")))
    return out.select(F.col("window.start").cast("timestamp_ntz").alias("start"), "jobs", F.round("seconds", 4).alias("seconds"))


@query("SELECT count(*) AS jobs, round(sum(value), 4) AS seconds FROM events")
def stream_snapshots(p: Proxies) -> DataFrame:
    """The state that the last batch left as a snapshot."""
    folder = _folder(p)
    state = _arriving(p).agg(F.count("*").alias("jobs"), F.sum("value").alias("seconds"))
    progress.snapshots(state, f"{folder}/snapshot", f"{folder}/checkpoint").awaitTermination()
    return p.spark.read.schema("jobs bigint, seconds double").json(f"{folder}/snapshot").select("jobs", F.round("seconds", 4).alias("seconds"))


# Small operators


@query(sql("SELECT scene, label, i, round(d, 6) AS seg FROM seg", "seg"))
def path_segments(p: Proxies) -> DataFrame:
    return paths.segments(p.path_point(), ["scene", "label"]).select("scene", "label", "i", F.round("seg", 6).alias("seg"))


@query(sql("SELECT label, round(sum(d), 6) AS length, round(sqrt(arg_max(x, i) ** 2 + arg_max(y, i) ** 2), 6) AS reach FROM seg GROUP BY label", "seg"))
def array_lengths(p: Proxies) -> DataFrame:
    """Length of a path as one array, and the distance of its end from the origin."""
    df = p.path_point().groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "x", "y"))).alias("a"))
    points = F.transform("a", lambda q: F.struct(q["x"].alias("x"), q["y"].alias("y")))
    end, n = F.element_at("a", -1), F.size("a")
    return df.select("label", F.when(n > 1, F.round(S.polyline_length(points), 6)).alias("length"), F.round(S.distance(F.lit(0.0), F.lit(0.0), end["x"], end["y"]), 6).alias("reach"))


@query("SELECT s_suppkey AS camera_id, row_number() OVER (ORDER BY s_name) - 1 AS place FROM supplier")
def cameras_by_name(p: Proxies) -> DataFrame:
    s = p.table("supplier").select("s_suppkey", "s_name")
    return s.join(planning.numbered(s, "s_name", "place"), "s_name").select(F.col("s_suppkey").alias("camera_id"), "place")


@query(sql("SELECT 'scale_' AS form, pid, round(s0, 6) AS x, round(s1, 6) AS y FROM point UNION ALL SELECT 'scales_', pid, round(s1, 6), round(s0, 6) FROM point UNION ALL SELECT 'scale', pid, round(z, 6), round(z, 6) FROM point UNION ALL SELECT 'none', pid, 0, 0 FROM point", "point"))
def scale_families(p: Proxies) -> DataFrame:
    """Scales whatever their columns are called."""
    base = p.point()
    forms = {"scale_": {"scale_0": "s0", "scale_1": "s1", "scale_2": "s2"}, "scales_": {"scales_0": "s1", "scales_1": "s0", "scales_2": "s2"}, "scale": {"scale": "z"}, "none": {}}
    out = None
    for form, names in forms.items():
        df = base.select("pid", *(F.col(c).alias(n) for n, c in names.items()))
        part = df.select(F.lit(form).alias("form"), "pid", *inventory.scale_columns(df)).select("form", "pid", F.round("scale_x", 6).alias("x"), F.round("scale_y", 6).alias("y"))
        out = part if out is None else out.union(part)
    return out


@query(sql("SELECT label, CASE WHEN frames < 3 THEN 'fewer than 3 frames' END AS reason FROM inventory", "inventory"))
def least_frames(p: Proxies) -> DataFrame:
    """Rows below the least number of frames stay, with their reason."""
    return p.inventory().select("label", planning.first_reason((F.col("frames") < 3, "fewer than 3 frames")).alias("reason"))


@query("SELECT c_custkey, c_nationkey % 5 IN (0, 2) AS yes FROM customer")
def truth_values(p: Proxies) -> DataFrame:
    text = F.element_at(F.array(*map(F.lit, (" YES ", "off", "1", "", "maybe"))), (F.col("c_nationkey") % 5 + 1).cast("int"))
    return p.table("customer").select("c_custkey", S.truth(text).alias("yes"))


@query(sql("SELECT scene, actor_id, arg_max(label, ordinal) AS label, max(ordinal) AS ordinal FROM assignment GROUP BY ALL", "assignment"))
def last_assignments(p: Proxies) -> DataFrame:
    df = p.assignment().select("scene", "actor_id", "label", "ordinal")
    return planning.last_row(df, ["scene", "actor_id"], "ordinal").select("scene", "actor_id", "label", "ordinal")


@query(sql("SELECT scene, arg_min(x, (label, i)) AS x, 2.15::DOUBLE AS z, round(0.5 / 0.28209479177387814, 6) AS red, round(ln(0.95 / 0.05), 6) AS opacity FROM path_point GROUP BY scene", "path_point"))
def path_markers(p: Proxies) -> DataFrame:
    """A red marker at hip height over the first point of each scene."""
    start = p.path_point().groupBy("scene").agg(F.min_by("x", F.struct("label", "i")).alias("px"))
    m = cameras.marker(0.0, 0.0, 1.25, 0.9)
    return start.select("scene", (F.col("px") + m["x"]).alias("x"), F.round(m["z"], 6).alias("z"), F.round(F.get(m["f_dc"], 0), 6).alias("red"), F.round(m["opacity"], 6).alias("opacity"))


@query(sql("SELECT pid, round(x / greatest(sqrt(x * x + y * y + z * z), 1e-12), 6) AS x, round(z / greatest(sqrt(x * x + y * y + z * z), 1e-12), 6) AS z FROM point", "point"))
def unit_vectors(p: Proxies) -> DataFrame:
    n = cameras.normal([F.col(c) for c in "xyz"])
    return p.point().select("pid", F.round(n[0], 6).alias("x"), F.round(n[2], 6).alias("z"))


_DEGREE_4 = """WITH d AS (SELECT vec_id AS pid, embedding AS e, embedding[62]::DOUBLE AS a, embedding[63]::DOUBLE AS b, embedding[64]::DOUBLE AS c FROM embeddings),
u AS (SELECT *, a / n AS x, b / n AS y, c / n AS z FROM (SELECT *, sqrt(a * a + b * b + c * c) AS n FROM d))
SELECT pid, round(greatest(0.5 + 0.28209479177387814::DOUBLE * e[1]::DOUBLE + (3.0::DOUBLE / 16 * sqrt(1 / pi())) * (z * z * (35 * z * z - 30) + 3) * e[21]::DOUBLE + (3.0::DOUBLE / 4 * sqrt(35 / pi())) * x * y * (x * x - y * y) * e[17]::DOUBLE, 0), 5) AS red FROM u"""


@query(_DEGREE_4)
def harmonic_colour_4(p: Proxies) -> DataFrame:
    """Colours of degree 4, from a constant and two functions of that degree."""
    e = p.table("embeddings").select(F.col("vec_id").alias("pid"), F.transform("embedding", lambda v: v.cast("double")).alias("e"))
    kept = F.transform(F.slice("e", 1, 25), lambda v, k: F.when(k.isin(0, 16, 20), v).otherwise(0.0))
    colour = cameras.harmonic_colours(F.concat(kept, kept, kept), F.slice("e", 62, 3))
    return e.select("pid", F.round(F.get(colour, 0), 5).alias("red"))


@query("""SELECT label, place, round(cos(radians(yaw)), 9) + 0 AS r00, round(-sin(radians(yaw)) * cos(radians(pitch)), 9) + 0 AS r01, round(cos(radians(yaw)) * cos(radians(pitch)), 9) + 0 AS r11, round(sin(radians(pitch)), 9) + 0 AS r21
FROM (SELECT 0 AS label, k AS place, -90.0::DOUBLE + 30 * k AS pitch, 0.0::DOUBLE AS yaw FROM range(7) AS t(k) UNION ALL SELECT 1, k, 0, 30.0 * k FROM range(12) AS t(k))""")
def orbit_rotations(p: Proxies) -> DataFrame:
    """Rotations of the orbit's pitch sweep and yaw sweep; a generator that reads no table."""
    from .clouds import orbit_angles

    a = orbit_angles(p)
    m = cameras.orbit_rotation(F.col("pitch"), F.col("yaw"))
    return a.select("label", "place", *((F.round(c, 9) + 0).alias(n) for n, c in (("r00", m[0][0]), ("r01", m[0][1]), ("r11", m[1][1]), ("r21", m[2][1]))))


@query(sql("SELECT pid, round((x / 2 * 2 * 500 / 640 + (2 * 300 / 640.0::DOUBLE - 1)), 6) AS u, round(y / 2 * 2 * 400 / 480 + (2 * 250 / 480.0::DOUBLE - 1), 6) AS v FROM point", "point"))
def off_axis_projection(p: Proxies) -> DataFrame:
    """Points at depth 2 through a camera whose axis meets the image beside its middle."""
    lit = lambda v: F.lit(float(v))
    m = cameras.principal_projection(0.5, 100.0, lit(500), lit(400), lit(300), lit(250), lit(640), lit(480))
    u, v, _ = cameras.transform_point(m, [F.col("x"), F.col("y"), F.lit(2.0)])
    return p.point().select("pid", F.round(u, 6).alias("u"), F.round(v, 6).alias("v"))


@query(sql("SELECT pid, round(x / 3, 6) AS u, round(y / 2, 6) AS v FROM point", "point"))
def orthographic_points(p: Proxies) -> DataFrame:
    m = cameras.orthographic(F.lit(3.0), F.lit(2.0), 0.0, 10.0)
    u, v, _ = cameras.transform_point(m, [F.col("x"), F.col("y"), F.col("z")])
    return p.point().select("pid", F.round(u, 6).alias("u"), F.round(v, 6).alias("v"))


@query("SELECT vec_id, round(embedding[8]::DOUBLE, 6) AS columns_first, round(embedding[57]::DOUBLE, 6) AS rows_first FROM embeddings")
def mirrored_images(p: Proxies) -> DataFrame:
    """8 x 8 images with columns, and with rows, in reverse order: their first pixels."""
    e = p.table("embeddings")
    first = lambda columns: F.round(F.get(imaging.mirrored(F.col("embedding"), 8, columns), 0).cast("double"), 6)
    return e.select("vec_id", first(True).alias("columns_first"), first(False).alias("rows_first"))
