"""Files written here are read back."""

import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark.sources import clouds, documents, sinks
from waymark.streaming import progress


def test_path_documents(spark, tmp_path):
    scene = tmp_path / "s1" / "label_paths"
    scene.mkdir(parents=True)
    good = {"path": {"keypoints_world": [{"x": 0, "y": 0}, {"x": 3, "y": 4}, {"x": None, "y": 1}], "raster_pixel": [[1, 2]], "raster_world": [{"x": 1, "y": 2}]}, "label": {"label": "chair"}}
    (scene / "a.json").write_text(json.dumps(good))
    (scene / "b.json").write_text(json.dumps({"path": {"keypoints_world": [{"x": 0, "y": 0}]}}))
    (scene / "c.json").write_text("{no json")
    paths, failures = documents.path_documents(spark, f"{tmp_path}/*/label_paths/*.json")
    r = documents.path_metrics(paths).first()
    assert (r.scene, r.label_id, r.label_name, r.path_length, r.keypoint_count, r.raster_steps) == ("s1", "a", "chair", 5.0, 2, 1)
    assert {(f.label_stem, f.reason) for f in failures.collect()} == {("b", "fewer than 2 usable points"), ("c", "malformed document")}
    raster = {r.label_stem: r for r in documents.raster_points(spark, f"{tmp_path}/*/label_paths/*.json", swap=True).collect()}
    assert (raster["a"].x, raster["a"].y, raster["a"].u) == (2.0, 1.0, 1) and raster["b"].reason and raster["c"].reason


def test_manifest_round_trip(spark, tmp_path):
    actors = spark.createDataFrame([("u",), ("v",)], "id string")
    labels = spark.createDataFrame([("s", "a"), ("s", "b")], "scene string, label string")
    rows = labels.withColumns({"actor_id": F.lit("u"), "round": F.lit(0), "order_index": F.lit(0)})
    lines = sinks.manifest(rows.withColumn("order_index", F.when(F.col("label") == "b", 10).otherwise(2)), actors, 33, labels)
    sinks.write_document(lines, str(tmp_path / "whole.json"))
    text = (tmp_path / "whole.json").read_text()
    document = json.loads(text)
    assert document["seed"] == 33 and [a["label"] for a in document["assignments"]] == ["a", "b"] and json.loads("".join(r.value for r in lines.collect())) == document
    assert document["per_actor_counts"] == {"u": 2, "v": 0} and document["label_count"] == 2 and list(document) == sorted(document)
    (tmp_path / "m.json").write_text(text)
    assignments, found = documents.manifest(spark, str(tmp_path / "m.json"))
    assert assignments.count() == 2 and found.count() == 2


def test_report(spark):
    got = json.loads(sinks.report({"a": spark.range(2), "b": spark.range(0)}).first().value)
    assert got == {"a": [{"id": 0}, {"id": 1}], "b": []}


def test_inventory_ids_png(spark, tmp_path):
    (tmp_path / "s").mkdir()
    head = b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", 640, 480)
    (tmp_path / "s" / "x.png").write_bytes(head + b"0" * 20)
    (tmp_path / "s" / "y.png").write_bytes(b"no png" * 9)
    (tmp_path / "ids.txt").write_text(" a \n#b\n\na\nc\n")
    inv = documents.inventory(spark, str(tmp_path / "s"))
    assert {(r.scene, r.stem, r.suffix) for r in inv.collect()} == {("s", "x", ".png"), ("s", "y", ".png")}
    assert [(r.width, r.height) for r in documents.png_sizes(spark, f"{tmp_path}/s/*.png").collect()] == [(640, 480)]
    assert {r.id for r in documents.id_list(spark, str(tmp_path / "ids.txt")).collect()} == {"a", "c"}


def test_ply_round_trip(spark, tmp_path):
    columns = {"x": np.arange(5, dtype="f4"), "f_rest_10": np.full(5, 2, "f4"), "f_rest_9": np.full(5, 1, "f4"), "packed": np.full(5, 4294967295, "u4")}
    (tmp_path / "a.ply").write_bytes(clouds.ply_bytes(columns))
    spark.dataSource.register(clouds.PlySource)
    df = spark.read.format("ply").option("path", f"{tmp_path}/*.ply").load()
    assert [(r.i, r.x, r.packed) for r in df.orderBy("i").collect()] == [(k, float(k), 4294967295) for k in range(5)]
    assert clouds.gaussians(df).first().f_rest == [1.0, 2.0]
    again = clouds.ply_rows(spark, f"{tmp_path}/a.ply", "x float, packed bigint")
    assert again.count() == 5
    df.select("x").coalesce(1).write.format("ply").mode("append").save(str(tmp_path / "out"))
    back = spark.read.format("ply").option("path", f"{tmp_path}/out/*.ply").load()
    assert [r.x for r in back.orderBy("i").collect()] == [0, 1, 2, 3, 4]
    text = b"ply\nformat ascii 1.0\nelement vertex 2\nproperty float x\nproperty uchar r\nend_header\n1.5 2\n2.5 3\n"
    assert clouds.ply_decode(text)["r"].tolist() == [2, 3]
    with pytest.raises(ValueError):
        clouds.ply_header(b"nonsense")


def test_colmap_text_and_binary(spark, tmp_path):
    t, b = tmp_path / "t", tmp_path / "b"
    t.mkdir(), b.mkdir()
    (t / "cameras.txt").write_text("# c\n1 PINHOLE 640 480 500 500 320 240\n")
    (b / "cameras.bin").write_bytes(struct.pack("<Q", 1) + struct.pack("<iiQQ4d", 1, 1, 640, 480, 500, 500, 320, 240))
    (t / "images.txt").write_text("1 1 0 0 0 1 2 3 1 a.png\n10 20 7 30 40 -1\n2 1 0 0 0 1 2 3 1 b.png\n\n")
    (b / "images.bin").write_bytes(struct.pack("<Q", 1) + struct.pack("<i7di", 1, 1, 0, 0, 0, 1, 2, 3, 1) + b"a.png\0" + struct.pack("<Q", 2) + struct.pack("<ddqddq", 10, 20, 7, 30, 40, -1))
    (t / "points3D.txt").write_text("7 1 2 3 10 20 30 0.5 1 0 2 4\n")
    (b / "points3D.bin").write_bytes(struct.pack("<Q", 1) + struct.pack("<Q3d3BdQ", 7, 1, 2, 3, 10, 20, 30, 0.5, 2) + struct.pack("<4i", 1, 0, 2, 4))
    for table in ("cameras", "points3D"):
        assert [tuple(r) for r in clouds.colmap(spark, str(t), table).collect()] == [tuple(r) for r in clouds.colmap(spark, str(b), table).collect()]
    text = {r.name: r for r in clouds.colmap(spark, str(t), "images").collect()}
    binary = clouds.colmap(spark, str(b), "images").first()
    assert text["a.png"] == binary and text["b.png"].xys == []
    line = sinks.colmap_text_points(clouds.colmap(spark, str(t), "points3D")).first().value
    assert line.startswith("7 1.0 2.0 3.0 10 20 30 0.5 1 0 2 4")


def test_dense_and_poses(spark, tmp_path):
    data = np.arange(6, dtype="<f4")
    assert clouds.dense_array(b"3&2&1&" + data.tobytes()).shape == (2, 3)
    buffer = np.zeros((4, 3, 4))
    buffer[2] = 1
    np.save(tmp_path / "p.npy", buffer)
    got = clouds.poses(spark, str(tmp_path / "p.npy")).collect()
    assert [r.i for r in got] == [2] and got[0].pose == [[1.0] * 4] * 3


def test_hosts_and_iterations(spark):
    lines = spark.createDataFrame(list(enumerate(["Host a", "  HostName 10.0.0.1", "  User u", "Password x", "Host b", "HostName 10.0.0.2"])), "k long, value string")
    assert [tuple(r) for r in documents.host_stanzas(lines).orderBy("host").collect()] == [("a", "10.0.0.1", "u", None), ("b", "10.0.0.2", None, None)]
    names = spark.createDataFrame([("iteration_7000",), ("iteration_30000",), ("x",)], "name string")
    assert documents.latest_iteration(names).first().iteration == 30000


def test_stream_equals_batch(spark, tmp_path):
    rows = spark.createDataFrame([("s", "a", "FAILED"), ("s", "a", "SUCCESS"), ("s", "b", "FAILED")], "scene string, actor string, status string")
    rows.write.parquet(str(tmp_path / "log"))
    stream = progress.finished(spark, str(tmp_path / "log"), rows.schema, files=1)
    got = progress.drain(progress.resume_stream(stream, ["scene", "actor"]), checkpoint=str(tmp_path / "c"))
    assert {(r.actor, r.state) for r in got.collect()} == {("a", "completed"), ("b", "failed")}
    progress.snapshots(progress.resume_stream(stream, ["scene"]), str(tmp_path / "snap"), str(tmp_path / "c2")).awaitTermination()
    assert spark.read.json(str(tmp_path / "snap")).first().state == "completed"
    (tmp_path / "none").mkdir()
    late = progress.finished(spark, str(tmp_path / "none"), rows.schema)
    assert progress.drain(progress.resume_stream(late, ["scene"])).count() == 0


def test_colmap_text_written_and_read(spark, tmp_path):
    t = tmp_path / "t"
    t.mkdir()
    (t / "cameras.txt").write_text("1 PINHOLE 640 480 500 500 320 240\n")
    (t / "images.txt").write_text("1 1 0 0 0 1 2 3 1 a.png\n10 20 7 30 40 -1\n2 1 0 0 0 1 2 3 1 b.png\n\n")
    for table, write in (("cameras", sinks.colmap_text_cameras), ("images", sinks.colmap_text_images)):
        first = clouds.colmap(spark, str(t), table)
        out = tmp_path / f"again_{table}"
        out.mkdir()
        (out / f"{table}.txt").write_text("\n".join(r.value for r in write(first).collect()) + "\n")
        assert clouds.colmap(spark, str(out), table).collect() == first.collect()


def test_quality_results(spark):
    rows = spark.createDataFrame([("s", "m", "a", 1.0), ("s", "m", "b", 3.0)], "scene string, method string, image string, PSNR double")
    assert json.loads(sinks.quality_results(rows).first().value) == {"s": {"m": {"PSNR": 2.0}}}


def test_depth_parameters_and_empty_documents(spark):
    rows = spark.createDataFrame([('b"x', 1.0, 2.0), ("a", 3.0, None)], "image_name string, scale double, offset double")
    got = json.loads("".join(r.value for r in sinks.depth_parameters(rows).collect()))
    assert got == {'b"x': {"scale": 1.0, "offset": 2.0}, "a": {"scale": 3.0}}
    assert json.loads("".join(r.value for r in sinks.depth_parameters(rows.where("false")).collect())) == {}


def test_colmap_binary_written_and_read(spark, tmp_path):
    t, b = tmp_path / "t", tmp_path / "b"
    t.mkdir(), b.mkdir()
    (t / "cameras.txt").write_text("2 SIMPLE_RADIAL 640 480 500 320 240 0.1\n1 PINHOLE 640 480 500 500 320 240\n")
    (t / "images.txt").write_text("1 1 0 0 0 1 2 3 1 \u00e4 b.png\n10 20 7 30 40 -1\n2 1 0 0 0 1 2 3 1 b.png\n\n")
    (t / "points3D.txt").write_text("7 1 2 3 10 20 30 0.5 1 0 2 4\n3 1 2 3 255 0 30 0.5\n")
    for table in ("cameras", "images", "points3D"):
        first = clouds.colmap(spark, str(t), table)
        sinks.write_colmap(first, str(b), table)
        again = clouds.colmap(spark, str(b), table).collect()
        assert sorted(map(repr, again)) == sorted(map(repr, first.collect()))
        assert [r[0] for r in again] == sorted(r[0] for r in again)


def test_colmap_in_slices(spark, tmp_path):
    """A model of several slices is read by several tasks, whatever the store, and long images and repeated ids come back whole."""
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.slices.link./in", f"file://{tmp_path}")
    n = F.when(F.col("id") == 7, 40_000).when(F.col("id") % 10 == 3, 0).otherwise(1300).cast("int")
    points = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    images = spark.range(120).select(
        F.greatest("id", F.lit(2)).alias("image_id"), F.array(*map(F.lit, (1.0, 0.0, 0.0, 0.0))).alias("qvec"), F.array(F.col("id") / 4, F.lit(2.0), F.lit(3.0)).alias("tvec"), F.lit(1).cast("long").alias("camera_id"), F.format_string("%d b.png", "id").alias("name"),
        F.transform(points, lambda k: F.struct((k / 4).alias("x"), (k * 1.5).cast("double").alias("y"))).alias("xys"), F.transform(points, lambda k: k.cast("long") + (1 << 60)).alias("point3d_ids"),
    )
    sinks.write_colmap(images, f"file://{tmp_path}/b", "images")
    sinks.write_document(sinks.colmap_text_images(images), f"file://{tmp_path}/t/images.txt")
    want = {r.name: r for r in images.collect()}
    for form in "bt":
        df = clouds.colmap(spark, f"file://{tmp_path}/{form}", "images")
        assert df.select(F.spark_partition_id()).distinct().count() > 1
        for got in (df.collect(), clouds.colmap(spark, f"viewfs://slices/in/{form}", "images").collect()):
            assert len(got) == 120 and {r.name: r for r in got} == want
