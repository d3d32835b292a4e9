"""Views of the driver's tables that stand for paths, assignments, inventories, logs and clouds.

Each view comes twice: as a DataFrame and as a DuckDB common table expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F


class Proxies:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def path_point(self) -> DataFrame:
        order = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
        lines = self.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_discount")
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        owner = self.table("customer").select("c_custkey", "c_nationkey")
        scenes = orders.join(owner, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
        df = lines.withColumn("i", F.row_number().over(order).cast("long")).join(scenes, F.col("l_orderkey") == F.col("o_orderkey"))
        return df.select(F.col("c_nationkey").alias("scene"), F.col("l_orderkey").alias("label"), "i", F.col("l_quantity").alias("x"), (F.col("l_discount") * 100).alias("y"))

    def assignment(self) -> DataFrame:
        owner = self.table("customer").select("c_custkey", "c_nationkey")
        df = self.table("orders").join(owner, F.col("o_custkey") == F.col("c_custkey"))
        return df.select(F.col("o_orderkey").alias("ordinal"), F.col("c_nationkey").alias("scene"), F.col("o_orderkey").alias("label"), F.col("o_custkey").alias("actor_id"), F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("price"))

    def actor(self) -> DataFrame:
        return self.table("customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("speed"), F.col("c_mktsegment").alias("kind"))

    def frame(self) -> DataFrame:
        order = W.partitionBy("user_id").orderBy("ts", "event_id")
        df = self.table("events").withColumn("i", F.row_number().over(order).cast("long"))
        return df.select(F.col("user_id").alias("path"), "i", F.col("value").alias("x"), F.get_json_object("props", "$.k").cast("double").alias("y"))

    def inventory(self) -> DataFrame:
        return self.table("lineitem").groupBy(F.col("l_orderkey").alias("label")).agg(
            F.sum("l_extendedprice").alias("size"), F.count("*").alias("frames"), F.count_if(F.col("l_linestatus") == "O").alias("depth"), F.count_if(F.col("l_returnflag") == "R").alias("rgb")
        )

    def logline(self) -> DataFrame:
        status = F.when(F.col("event_type") == "purchase", "SUCCESS").when(F.col("event_type") == "error", "FAILED")
        df = self.table("events").select(F.col("user_id").alias("scene"), (F.floor("value") % 7).cast("long").alias("actor"), status.alias("status"), F.col("event_id").alias("seq"))
        return df.where("status is not null")

    def point(self) -> DataFrame:
        e = self.table("embeddings")
        names = ["x", "y", "z", "opacity", "s0", "s1", "s2", "w", "qx", "qy", "qz", "g"]
        return e.select(F.col("label").alias("cloud"), F.col("vec_id").alias("pid"), *(F.get("embedding", k).cast("double").alias(n) for k, n in enumerate(names)))


#: The same views in DuckDB SQL.
CTE = {
    "path_point": """path_point AS (
  SELECT c_nationkey AS scene, l_orderkey AS label,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS i,
         l_quantity AS x, l_discount * 100 AS y
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)""",
    "assignment": """assignment AS (
  SELECT o_orderkey AS ordinal, c_nationkey AS scene, o_orderkey AS label, o_custkey AS actor_id, o_orderpriority AS priority, o_totalprice AS price
  FROM orders JOIN customer ON o_custkey = c_custkey)""",
    "actor": "actor AS (SELECT c_custkey AS id, c_acctbal AS speed, c_mktsegment AS kind FROM customer WHERE c_acctbal > 0)",
    "frame": """frame AS (
  SELECT user_id AS path, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i, value AS x,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS y FROM events)""",
    "inventory": """inventory AS (
  SELECT l_orderkey AS label, sum(l_extendedprice) AS size, count(*) AS frames,
         count(*) FILTER (l_linestatus = 'O') AS depth, count(*) FILTER (l_returnflag = 'R') AS rgb FROM lineitem GROUP BY 1)""",
    "logline": """logline AS (
  SELECT user_id AS scene, CAST(floor(value) % 7 AS BIGINT) AS actor,
         CASE event_type WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED' END AS status, event_id AS seq
  FROM events WHERE event_type IN ('purchase', 'error'))""",
    "point": "point AS (SELECT label AS cloud, vec_id AS pid, " + ", ".join(
        f"embedding[{k}]::DOUBLE AS {n}" for k, n in enumerate(["x", "y", "z", "opacity", "s0", "s1", "s2", "w", "qx", "qy", "qz", "g"], 1)
    ) + " FROM embeddings)",
    "seg": """seg AS (
  SELECT *, sqrt((x - lag(x) OVER w) * (x - lag(x) OVER w) + (y - lag(y) OVER w) * (y - lag(y) OVER w)) AS d
  FROM path_point WINDOW w AS (PARTITION BY label ORDER BY i))""",
    "metric": """metric AS (
  SELECT scene, label, count(*) AS keypoints, round(sum(d), 6) AS length,
         round(sqrt((arg_max(x, i) - arg_min(x, i)) ** 2 + (arg_max(y, i) - arg_min(y, i)) ** 2), 6) AS displacement,
         sqrt((arg_max(x, i) - arg_min(x, i)) ** 2 + (arg_max(y, i) - arg_min(y, i)) ** 2) AS far, sum(d) AS raw
  FROM seg GROUP BY ALL HAVING count(*) >= 2)""",
    "cum": """cum AS (
  SELECT scene, label, i, x, y, sum(coalesce(d, 0)) OVER (PARTITION BY label ORDER BY i) AS c FROM seg WHERE d IS NULL OR d > 1e-6)""",
    "plan": """plan AS (
  SELECT scene, label, i, row_number() OVER (PARTITION BY label ORDER BY i) - 1 AS frame, least(c, most) AS camera, least(least(c, most) + 15, total) AS person
  FROM (SELECT *, coalesce(sum(CASE WHEN least(c, most) >= most - 1e-6 THEN 1 ELSE 0 END) OVER (PARTITION BY label ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
        FROM (SELECT *, max(c) OVER (PARTITION BY label) AS total, greatest(max(c) OVER (PARTITION BY label) - 15, 0) AS most FROM cum))
  WHERE earlier = 0)""",
}
_NEEDS = {"seg": ["path_point"], "metric": ["seg"], "cum": ["seg"], "plan": ["cum"]}


def sql(body: str, *views: str, recursive: bool = False) -> str:
    """``body`` after the views it names, and those that they need."""
    order: list[str] = []

    def add(v: str) -> None:
        for n in _NEEDS.get(v, []):
            add(n)
        if v not in order:
            order.append(v)

    for v in views:
        add(v)
    body = body.strip()
    head = ",\n".join(CTE[v] for v in order)
    if body.startswith("WITH "):
        body = body[5:]
        return f"WITH {'RECURSIVE ' * recursive}{head}{', ' if head else ''}{body}"
    return f"WITH {head}\n{body}" if head else body


#: Places that leave no ties: values have six places at most, so means rarely and percentiles never end in a half.
DIGITS = (4, 8)
DESCRIBE = (
    "count({v}) AS {p}count, min({v}) AS {p}min, max({v}) AS {p}max, round(avg({v}), 4) AS {p}mean, round(quantile_cont({v}, 0.5), 8) AS {p}median, "
    "round(quantile_cont({v}, 0.1), 8) AS {p}p10, round(quantile_cont({v}, 0.9), 8) AS {p}p90, round(CASE WHEN count({v}) > 1 THEN stddev_pop({v}) END, 4) AS {p}stddev"
)


def describe_sql(value: str, prefix: str = "") -> str:
    return DESCRIBE.format(v=value, p=prefix)
