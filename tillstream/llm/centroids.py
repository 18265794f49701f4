"""Clusters around centroids, in integers, by expressions that Spark evaluates itself.

Components become integers, so every distance, sum and mean is exact and no result depends on the order
of rows. In a round the centroids are literal arrays of the plan: `zip_with` and `aggregate` give the
product of a vector with each of them, `array_min` over (distance, number) structs names the nearest one,
and one aggregation with a sum per component, partial before its shuffle, gives the next centroids. Only
centroids pass through the driver: their number times the components, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.registry import query, stored, table

CENTROIDS, ROUNDS, COMPONENTS, SCALE, SEED = 40, 5, 64, 256, 2


def scaled(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """vec_id and v, the components as integers floor(scale * x), of the vectors with exactly `components`
    components that are all finite numbers."""
    at = F.col("embedding")
    finite = F.forall(at, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False)))
    whole = F.transform(at, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    return vectors.where((F.size(at) == components) & finite).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


def _product(other: str) -> str:
    return f"aggregate(zip_with(v, {other}, (x, y) -> x * y), 0L, (s, x) -> s + x)"


def nearest(centroids: list[list[int]]) -> Column:
    """(distance, cluster) of the nearest centroid to `v`, whose square is in `square`; ties go to the
    smaller number. Written as SQL text: thousands of literals are one call to the JVM."""
    pairs = []
    for number, centroid in enumerate(centroids):
        literal = f"array({', '.join(f'{x}L' for x in centroid)})"
        distance = f"square + {sum(x * x for x in centroid)}L - 2L * {_product(literal)}"
        pairs.append(f"named_struct('distance', {distance}, 'cluster', {number})")
    return F.expr(f"array_min(array({', '.join(pairs)}))")


def first_centroids(points: DataFrame, centroids: int = CENTROIDS, seed: int = SEED) -> list[list[int]]:
    """The vectors whose ids have the smallest hashes; of one id the smaller vector comes first. Vectors
    without an id are taken when ids run out."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [r["v"] for r in points.orderBy(rank.asc_nulls_last(), "v").limit(centroids).select("v").collect()]


def moved(points: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: the exact floors of their vectors' means; one without vectors stays."""
    width = len(centroids[0])
    assigned = points.select(nearest(centroids)["cluster"].alias("cluster"), *[F.col("v")[i].alias(f"x{i}") for i in range(width)])
    sums = assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"x{i}").alias(f"x{i}") for i in range(width)])
    out = list(centroids)
    for r in sums.collect():
        out[r["cluster"]] = [r[f"x{i}"] // r["n"] for i in range(width)]
    return out


def centroid_clusters(
    vectors: DataFrame,
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    components: int = COMPONENTS,
    scale: int = SCALE,
    seed: int = SEED,
) -> tuple[DataFrame, list[list[int]]]:
    """(one row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256; the
    final centroids in order).

    Vectors that are null, of another length, or with a null or non-finite component are left out. With
    fewer vectors than centroids each vector starts one; an empty table gives no rows. Repeated rows count
    as often as they come and can start several centroids at one place, of which the first gets all vectors.
    Rows without vec_id are clustered like all others. Distances are exact in 64 bits: a component so large
    that its square does not fit ends the job with an error. Other columns are ignored.
    """
    points = scaled(vectors, components, scale)
    points = stored(points.withColumn("square", F.expr(_product("v"))), "points")
    now = first_centroids(points, centroids, seed)
    for _round in range(rounds if now else 0):
        now = moved(points, now)
    best = nearest(now) if now else F.lit(None).cast("struct<distance:long,cluster:int>")
    placed = stored(points.select("vec_id", F.inline(F.array(best))).select("vec_id", "cluster", "distance"), "clusters")
    inertias = {r["cluster"]: r["s"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    facts = [(k, s, sum(inertias.values()), digests[k]) for k, s in inertias.items()]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    found = placed.join(F.broadcast(vectors.sparkSession.createDataFrame(facts, schema)), "cluster")
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"), now


# ---- the same in SQL -----------------------------------------------------------------------


def _sql(centroids: int = CENTROIDS, rounds: int = ROUNDS) -> str:
    steps = [
        """kept as materialized (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64
)""",
        f"""c0 as materialized (
  select row_number() over (order by sha256('2:' || vec_id), v) - 1 as k, v from kept
  qualify k < {centroids}
)""",
    ]
    for n in range(rounds + 1):
        steps.append(
            f"""a{n} as materialized (
  select r, any_value(x.vec_id) as vec_id, any_value(x.v) as v,
         min({{'d': cast(list_sum(list_transform(list_zip(x.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as bigint), 'k': c.k}}) as best
  from kept x, c{n} c group by r
)"""
        )
        if n < rounds:
            steps.append(
                f"""s{n} as (
  select k, i, cast(sum(x) as bigint) as s, count(*) as n
  from (select best.k as k, unnest(v) as x, unnest(range(64)) as i from a{n}) group by k, i
), m{n} as (
  select k, list((s - ((s % n) + n) % n) // n order by i) as v from s{n} group by k
), c{n + 1} as materialized (
  select c.k, coalesce(m.v, c.v) as v from c{n} c left join m{n} m on m.k = c.k
)"""
            )
    joined = ",\n".join(steps)
    return f"""with {joined}
select a.vec_id, cast(best.k as int) as cluster, best.d as distance,
       cast(sum(best.d) over (partition by best.k) as bigint) as cluster_inertia,
       cast(sum(best.d) over () as bigint) as inertia,
       sha256(array_to_string(c.v, ',')) as centroid_sha256
from a{rounds} a join c{rounds} c on c.k = best.k"""


@query("op13_centroids", _sql())
def op13_centroids(spark, sf_dir):
    """The cluster of every vector."""
    return centroid_clusters(table(spark, sf_dir, "embeddings"))[0]
