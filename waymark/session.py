"""What a Spark session needs before queries run."""

from __future__ import annotations

import tempfile
import weakref
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: weakref.WeakSet = weakref.WeakSet()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once for each Spark context."""
    context = spark.sparkContext
    if context in _shipped:
        return
    top = Path(__file__).parent
    where = Path(tempfile.mkdtemp(prefix="waymark-code-")) / "waymark_code.zip"
    with zipfile.ZipFile(where, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, f"{top.name}/{p.relative_to(top)}")
    context.addPyFile(str(where))
    _shipped.add(context)


def local(cpus: int | str = "*", memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    n = 8 if cpus == "*" else int(cpus)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("waymark")
        .config("spark.sql.shuffle.partitions", n)
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
