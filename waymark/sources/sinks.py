"""Reports and manifests as JSON, errors as an append-only table."""

from __future__ import annotations

import json
import os
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .. import tables
from .clouds import CAMERA_MODELS


def report(sections: dict[str, DataFrame]) -> DataFrame:
    """One row with one JSON document: each section is the array of its rows, nulls left out.

    Sections are summaries, bounded by groups and top-k limits, not data.
    """
    out = None
    for name, df in sections.items():
        rows = df.agg(F.collect_list(F.struct("*")).alias(name))
        out = rows if out is None else out.crossJoin(rows)
    return out.select(F.to_json(F.struct(*sections)).alias("value"))


def write_report(sections: dict[str, DataFrame], path: str) -> None:
    report(sections).coalesce(1).write.mode("overwrite").text(path)


def _quoted(text: Column) -> Column:
    """A text as a JSON string."""
    listed = F.to_json(F.array(text.cast("string")))
    return listed.substr(F.lit(2), F.length(listed) - 2)


def map_lines(df: DataFrame, key: str = "k", value: str = "v") -> DataFrame:
    """(t, k, at, value): the lines of a JSON object of names (``key``) and JSON texts (``value``), to be sorted by the first three."""
    return _lines(df.select(F.col(key).cast("string").alias("k"), F.concat(_quoted(F.col(key)), F.lit(":"), F.col(value)).alias("v")), "{", "}")


def list_lines(df: DataFrame, key: str = "k", value: str = "v") -> DataFrame:
    """(t, k, at, value): the lines of a JSON array of JSON texts in order of ``key``, to be sorted by the first three."""
    return _lines(df.select(F.col(key).cast("string").alias("k"), F.col(value).alias("v")), "[", "]")


def _lines(df: DataFrame, opened: str, closed: str) -> DataFrame:
    rows = tables.table(df.withColumn("at", F.monotonically_increasing_id()), "lines")  # read for the first row, too
    first = rows.agg(F.min(F.struct("k", "at")).alias("first"))  # one row
    comma = F.when(F.struct("k", "at") == F.col("first"), "").otherwise(",")
    body = rows.crossJoin(F.broadcast(first)).select(F.lit(1).alias("t"), "k", "at", F.concat(comma, "v").alias("value"))
    edge = df.sparkSession.createDataFrame([(0, None, 0, opened), (2, None, 0, closed)], "t int, k string, at long, value string")
    return edge.unionByName(body)


def document_lines(sections: dict[str, DataFrame | str]) -> DataFrame:
    """(value): the lines of one JSON object with sorted keys, in order.

    A section is a JSON text, or lines of ``map_lines`` or ``list_lines``. The
    sort is global, in as many tasks as there are ranges: no row and no task
    holds the document. Written as text, the part files one after another are it.
    """
    spark = next(df.sparkSession for df in sections.values() if isinstance(df, DataFrame))
    lines = spark.createDataFrame([(len(sections), 0, None, 0, "}")], "s int, t int, k string, at long, value string")
    for n, name in enumerate(sorted(sections)):
        part, head = sections[name], ("," if n else "{") + json.dumps(name) + ":"
        if isinstance(part, str):
            lines = lines.unionByName(spark.createDataFrame([(n, 0, None, 0, head + part)], lines.schema))
        else:
            named = F.when(F.col("t") == 0, F.concat(F.lit(head), "value")).otherwise(F.col("value"))
            lines = lines.unionByName(part.withColumns({"s": F.lit(n), "value": named}))
    return lines.orderBy("s", "t", "k", "at").select("value")


def _sortable(*columns: str) -> Column:
    """A text that sorts like the numbers and texts of ``columns``."""
    return F.concat_ws("/", *(F.lpad(F.col(c).cast("string"), 20, "0") if c in ("round", "order_index") else F.col(c).cast("string") for c in columns))


def manifest(assignments: DataFrame, actors: DataFrame, seed: int, labels: DataFrame) -> DataFrame:
    """The lines of the manifest, one JSON object with sorted keys; actors without labels count 0."""
    per_actor = actors.select("id").join(assignments.groupBy(F.col("actor_id").alias("id")).agg(F.count("*").alias("n")), "id", "left")
    size = labels.agg(F.count("*").alias("labels"), F.count_distinct("scene").alias("scenes")).first()
    rows = assignments.select(_sortable("round", "order_index", "scene", "label").alias("k"), F.to_json(F.struct("round", "order_index", "scene", "label", "actor_id")).alias("v"))
    return document_lines(
        {
            "actors": list_lines(actors.select(F.col("id").alias("k"), F.to_json(F.struct("*")).alias("v"))),
            "assignments": list_lines(rows),
            "label_count": str(size.labels),
            "per_actor_counts": map_lines(per_actor.select(F.col("id").alias("k"), F.coalesce("n", F.lit(0)).cast("string").alias("v"))),
            "scene_count": str(size.scenes),
            "seed": str(seed),
        }
    )


def write_document(lines: DataFrame, path: str) -> None:
    """Write lines in their order as one file: parts first, then put together by the driver, a buffer at a time."""
    spark = lines.sparkSession
    lines.write.mode("overwrite").text(f"{path}.parts")
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    folder = jvm.org.apache.hadoop.fs.Path(f"{path}.parts")
    fs = place.getFileSystem(conf)
    out = fs.create(place, True)
    for part in sorted(x.getPath().toString() for x in fs.listStatus(folder)):
        if part.rsplit("/", 1)[1].startswith("part-"):
            source = fs.open(jvm.org.apache.hadoop.fs.Path(part))
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, conf, False)
            source.close()
    out.close()
    fs.delete(folder, True)


def follow_metadata(plan: DataFrame, path: str) -> None:
    """Frame plans as JSON, one folder for each scene."""
    plan.write.mode("overwrite").partitionBy("scene").json(path)


def append_errors(errors: DataFrame, path: str, at: Column | None = None) -> None:
    errors.withColumn("at", F.current_timestamp() if at is None else at).write.mode("append").parquet(path)


def depth_parameters(df: DataFrame) -> DataFrame:
    """The lines of one JSON object that maps image names to scale and offset."""
    return map_lines(df.select("image_name", F.to_json(F.struct("scale", "offset")).alias("v")), "image_name").orderBy("t", "k", "at").select("value")


def colmap_text_points(points: DataFrame) -> DataFrame:
    """Lines of ``points3D.txt``."""
    track = F.array_join(F.flatten(F.zip_with("image_ids", "point2d_idxs", lambda a, b: F.array(a, b))).cast("array<string>"), " ")
    return points.select(F.concat_ws(" ", F.col("point3d_id").cast("string"), F.array_join(F.col("xyz").cast("array<string>"), " "), F.array_join(F.col("rgb").cast("array<string>"), " "), F.col("error").cast("string"), track).alias("value"))


def command_lines(plans: DataFrame, script: str, follow: float) -> DataFrame:
    """One command for each job plan."""
    return plans.withColumn(
        "command",
        F.concat_ws(" ", F.lit(f"python {script}"), F.format_string("--scene %s", F.col("scene").cast("string")), F.format_string("--actor %s", F.col("actor_id").cast("string")),
                    F.concat(F.lit("--labels "), F.array_join(F.col("labels").cast("array<string>"), ",")), F.lit(f"--follow-distance {follow:.6f}")),
    )


def quality_results(rows: DataFrame) -> DataFrame:
    """One JSON document of mean measures by scene and method; ``rows`` has scene, method and the measures."""
    measures = [c for c in rows.columns if c not in ("scene", "method", "image")]
    means = rows.groupBy("scene", "method").agg(*(F.avg(c).alias(c) for c in measures))
    methods = means.groupBy("scene").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("method", F.struct(*measures))))).alias("m"))
    by_scene = lambda a, b: F.when(a["scene"] < b["scene"], -1).when(a["scene"] > b["scene"], 1).otherwise(0)
    return methods.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("scene", "m")), by_scene))).alias("value"))


def colmap_text_cameras(cameras: DataFrame) -> DataFrame:
    """Lines of ``cameras.txt``."""
    return cameras.select(F.concat_ws(" ", F.col("camera_id").cast("string"), "model", F.col("width").cast("string"), F.col("height").cast("string"), F.array_join(F.col("params").cast("array<string>"), " ")).alias("value"))


def colmap_text_images(images: DataFrame) -> DataFrame:
    """Lines of ``images.txt``, two for each image, in order of image and line."""
    numbers = lambda c: F.array_join(F.col(c).cast("array<string>"), " ")
    head = F.concat_ws(" ", F.col("image_id").cast("string"), numbers("qvec"), numbers("tvec"), F.col("camera_id").cast("string"), "name")
    seen = F.array_join(F.zip_with("xys", "point3d_ids", lambda q, p: F.concat_ws(" ", q["x"].cast("string"), q["y"].cast("string"), p.cast("string"))), " ")
    rows = images.withColumn("row", F.monotonically_increasing_id())  # keeps the lines of repeated ids apart
    return rows.select("image_id", "row", F.posexplode(F.array(head, seen)).alias("line", "value")).orderBy("image_id", "row", "line").select("value")


def camera_documents(cameras: DataFrame) -> DataFrame:
    """One JSON document for each camera row."""
    return cameras.select(F.to_json(F.struct("*")).alias("value"))


_MODELS = {name: number for number, (name, _) in CAMERA_MODELS.items()}


def _camera_record(r: dict) -> bytes:
    return struct.pack(f"<iiQQ{len(r['params'])}d", r["camera_id"], _MODELS[r["model"]], r["width"], r["height"], *r["params"])


def _image_pieces(b: pa.RecordBatch) -> list[bytes]:
    """The head of an image, in its first piece, and the points of each piece."""
    flat = b.column("seen").flatten()
    points = np.zeros(len(flat), [("x", "<f8"), ("y", "<f8"), ("p", "<i8")])
    for n in "xy":
        points[n] = flat.field(n).to_numpy(zero_copy_only=False)
    points["p"] = flat.field("p").to_numpy()  # a null fails
    out, a = [], 0
    for r, m in zip(b.column("head").to_pylist(), b.column("seen").value_lengths().to_pylist()):
        head = struct.pack("<i7di", r["image_id"], *r["qvec"], *r["tvec"], r["camera_id"]) + r["name"].encode() + b"\0" + struct.pack("<Q", r["seen"]) if r else b""
        out.append(head + points[a : a + m].tobytes())
        a += m
    return out


def _point_record(r: dict) -> bytes:
    track = np.array([r["image_ids"], r["point2d_idxs"]], "<i4").T
    return struct.pack("<Q3d3BdQ", r["point3d_id"], *r["xyz"], *r["rgb"], r["error"], len(track)) + track.tobytes()


#: By table: the id that orders records, the writer of a batch, and the rows of a task.
_RECORDS = {
    "cameras": ("camera_id", lambda b: [_camera_record(r) for r in b.to_pylist()], 100_000),
    "images": ("image_id", _image_pieces, 1000),
    "points3D": ("point3d_id", lambda b: [_point_record(r) for r in b.to_pylist()], 100_000),
}
#: Points of an image in one piece, so that a task's rows are of a bounded size however many points an image has.
POINTS = 512
_ORDER = ["id", "row", "k"]


def _pieces(df: DataFrame, table: str) -> DataFrame:
    """(id, row, k, ...): the rows of a camera model's table; images in pieces of ``POINTS`` points."""
    rows = df.select(F.col(_RECORDS[table][0]).cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), "*")
    if table != "images":
        return rows.withColumn("k", F.lit(0))
    ids = F.col("point3d_ids")
    seen = F.transform("xys", lambda q, i: F.struct(q["x"].alias("x"), q["y"].alias("y"), F.when(i < F.size(ids), F.get(ids, i)).otherwise(0).alias("p")))
    rows = rows.withColumn("seen", F.coalesce(seen, F.array().cast("array<struct<x:double,y:double,p:bigint>>")))
    last = F.greatest(F.ceil(F.size("seen") / POINTS).cast("int") - 1, F.lit(0))
    head = F.struct("image_id", "qvec", "tvec", "camera_id", "name", F.size("seen").cast("long").alias("seen"))
    cut = rows.select("id", "row", "seen", head.alias("head"), F.explode(F.sequence(F.lit(0), last)).alias("k"))
    return cut.select("id", "row", "k", F.when(F.col("k") == 0, F.col("head")).alias("head"), F.slice("seen", F.col("k") * POINTS + 1, POINTS).alias("seen"))


def write_colmap(df: DataFrame, folder: str, table: str) -> None:
    """Write ``cameras``, ``images`` or ``points3D`` as ``.bin``: one file by its format, records in order of id.

    Records are made by the executors and pass through the driver a partition at a time.
    """
    spark = df.sparkSession
    _, write, most = _RECORDS[table]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([*(b.column(c) for c in _ORDER), pa.array(write(b), pa.binary())], names=[*_ORDER, "record"])

    rows = tables.table(_pieces(df, table), "rows")
    parts = 1 + rows.count() // most
    records = tables.table(rows.repartitionByRange(parts, *_ORDER).mapInArrow(of, "id long, row long, k int, record binary"), "records")
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(f"{folder}/{table}.bin")
    out = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place, True)
    held = bytearray(struct.pack("<Q", rows.where("k = 0").count()))
    for r in records.repartitionByRange(parts, *_ORDER).sortWithinPartitions(*_ORDER).select("record").toLocalIterator():
        held += r.record
        if len(held) > 1 << 20:
            out.write(held)
            held = bytearray()
    out.write(held)
    out.close()
    tables.discard(rows)
    tables.discard(records)


def write_lines(lines: DataFrame, folder: str) -> None:
    """Write (value) as text."""
    lines.write.mode("overwrite").text(folder)


def write_files(df: DataFrame, folder: str) -> int:
    """Write each row of ``df`` (name, content) as a file below ``folder``, which all machines must have mounted; the number of files."""
    where = folder.removeprefix("file://")
    if "://" in where:
        raise ValueError("single files are written to mounted folders only")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column("name").to_pylist(), b.column("content").to_pylist()):
                path = os.path.join(where, name)
                os.makedirs(os.path.dirname(path), exist_ok=True)
                with open(f"{path}.{os.getpid()}", "wb") as f:
                    f.write(content)
                os.replace(f"{path}.{os.getpid()}", path)  # a second attempt of a task writes the same again
            yield pa.record_batch([pa.array([b.num_rows], pa.int64())], names=["n"])

    return df.select("name", F.col("content").cast("binary").alias("content")).mapInArrow(of, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
