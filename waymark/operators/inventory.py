"""Choices over file inventories: which folders, frames, clouds and formats to use."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import scalar as S


def discover(explicit: DataFrame, found: DataFrame, banned: DataFrame, key: str, order: str) -> DataFrame:
    """(key, source, order): explicit entries before found ones, each key once, none that is banned.

    Of equal keys the first stays, explicit before found.
    """
    both = explicit.select(key, order).withColumn("source", F.lit(0)).unionByName(found.select(key, order).withColumn("source", F.lit(1)))
    kept = both.join(banned.select(key).distinct(), key, "left_anti")
    first = kept.groupBy(key).agg(F.min(F.struct("source", order)).alias("__f"))
    return first.select(key, "__f.source", f"__f.{order}")


def frame_files(files: DataFrame, folder: str, name: str, pattern: str) -> DataFrame:
    """``.ply`` files whose name fits ``pattern`` (a regular expression); in folders without any, all ``.ply`` files."""
    clouds = files.where(F.lower(name).endswith(".ply"))
    hits = clouds.where(F.col(name).rlike(pattern))
    rest = clouds.join(hits.select(folder).distinct(), folder, "left_anti")
    return hits.unionByName(rest).withColumn("key", S.natural_key(name))


def scene_cloud(files: DataFrame, scene: str, name: str, preferred: Sequence[str]) -> DataFrame:
    """(scene, name): the first of the preferred names that a scene has, else its first ``.ply``."""
    rank = F.lit(len(preferred))
    for k, p in reversed(list(enumerate(preferred))):
        rank = F.when(F.col(name) == p, F.lit(k)).otherwise(rank)
    clouds = files.where(F.lower(name).endswith(".ply"))
    return clouds.groupBy(scene).agg(F.min(F.struct(rank.alias("r"), F.col(name).alias("n")))["n"].alias(name))


def scene_kind(files: DataFrame, scene: str, name: str) -> DataFrame:
    """(scene, kind): sparse models before transform documents; others are unknown."""
    has = lambda n: F.bool_or(F.col(name) == n)
    kind = F.when(has("sparse"), "colmap").when(has("transforms_train.json"), "transforms").otherwise("unknown")
    return files.groupBy(scene).agg(kind.alias("kind"))


def numeric_folders(files: DataFrame, name: str) -> DataFrame:
    return files.where(F.col(name).rlike("^[0-9]+$"))


def label_folder(files: DataFrame, scene: str, folder: str) -> DataFrame:
    """(scene, folder): ``label_paths`` where a scene has it, else the scene's own folder (empty name) if it has documents."""
    rank = F.when(F.col(folder) == "label_paths", 0).when(F.col(folder) == "", 1)
    ranked = files.withColumn("__r", rank).where("__r is not null")
    return ranked.groupBy(scene).agg(F.min_by(folder, "__r").alias(folder))


#: Lines of a host's report, in order.
HOST_LINES = ("host", "load", "cores", "mem_total_kb", "mem_available_kb", "uptime", "users", "stamp")


def host_status(reports: DataFrame, column: str) -> DataFrame:
    """Fields of reports of eight lines; numbers that cannot be read count 0, cores at least 1."""
    line = lambda k: F.get(F.split(column, "\n"), k)
    number = lambda c: F.coalesce(c.try_cast("double"), F.lit(0.0))
    load = number(F.get(F.split(F.trim(line(1)), r"\s+"), 0))
    cores = F.greatest(number(line(2)), F.lit(1.0))
    total, free = number(line(3)), number(line(4))
    used = F.coalesce(F.try_divide(total - free, F.nullif(total, F.lit(0.0))), F.lit(0.0))
    df = reports.select("*", F.trim(line(0)).alias("host"), load.alias("load1"), cores.alias("cores"), total.alias("mem_total_kb"), free.alias("mem_available_kb"))
    return df.withColumns({"cpu_pct": load / cores * 100, "mem_pct": used * 100}).withColumn("usage_pct", F.greatest("cpu_pct", "mem_pct"))


def exposures(images: DataFrame, known: DataFrame, name: str) -> DataFrame:
    """Images with their exposure, null where there is none."""
    return images.join(known, name, "left")


def debug_vertices(points: DataFrame, actor: int, red: int, green: int, blue: int) -> DataFrame:
    """x, y, z, scales and opacity (0 if absent) with a class and a colour."""
    opacity = F.coalesce("opacity", F.lit(0.0)) if "opacity" in points.columns else F.lit(0.0)
    constants = (("actor", actor), ("r", red), ("g", green), ("b", blue))
    return points.select("x", "y", "z", *scale_columns(points), opacity.alias("opacity"), *(F.lit(v).cast("smallint").alias(n) for n, v in constants))


def scale_columns(points: DataFrame) -> list[Column]:
    """scale_x, scale_y and scale_z from ``scale_0..``, ``scales_0..`` or one ``scale``; 0 without any."""
    names = ("scale_x", "scale_y", "scale_z")
    for prefix in ("scale_", "scales_"):
        if all(f"{prefix}{k}" in points.columns for k in range(3)):
            return [F.col(f"{prefix}{k}").alias(n) for k, n in enumerate(names)]
    one = F.col("scale") if "scale" in points.columns else F.lit(0.0)
    return [one.alias(n) for n in names]
