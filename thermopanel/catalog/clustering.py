"""Queries on grouping sites and scoring an assignment."""

from pyspark.sql import functions as F

from thermopanel.catalog import CLUSTERS_SQL, HOURLY, SEASON, frames, query
from thermopanel.catalog.aggregates import PATTERN_SQL
from thermopanel.operators import aggregates, clustering, joins, lloyd
from thermopanel.session import materialise

#: Lloyd's steps that the SQL twins replay, and their starts
STEPS, STARTS = 12, 10


def pattern_points(spark, d):
    """Sites with their patterns; written, as k-means reads them once per step."""
    patterns = aggregates.pattern_matrix(frames.ready_season(spark, d))
    return materialise(patterns.select("branch_id", clustering.filled_vector(aggregates.PATTERN_CELLS).alias("v")))


PATTERNS = f"""{SEASON}, cells AS (SELECT branch_id, {PATTERN_SQL} FROM ready GROUP BY 1), p AS MATERIALIZED (SELECT branch_id AS key,
    [{", ".join(f"coalesce({c}, 0)" for c in aggregates.PATTERN_CELLS)}] AS v FROM cells)"""


def lloyd_sql(ks, starts: int = STARTS, steps: int = STEPS, seed: int = lloyd.SEED) -> str:
    """WITH entries that replay k-means over p(key, v): best(k, key, v, cluster, d) of the cheapest start per k, and costs."""
    marks = " UNION ALL ".join(
        f"SELECT {s} AS start, v, row_number() OVER (ORDER BY md5('{seed + s}|' || key), key) AS r FROM p" for s in range(starts)
    )
    sizes = ", ".join(f"({k})" for k in ks)
    out = [
        f"firsts AS MATERIALIZED ({marks})",
        f"c0 AS MATERIALIZED (SELECT k, start, CAST(r - 1 AS INT) AS cluster, v FROM firsts JOIN (VALUES {sizes}) AS ks(k) ON r <= k)",
    ]
    for t in range(steps + 1):
        out.append(f"""a{t} AS MATERIALIZED (SELECT k, start, key, v, cluster, d FROM (SELECT k, start, key, p.v, cluster,
          list_distance(p.v, c.v) AS d, row_number() OVER (PARTITION BY k, start, key ORDER BY list_distance(p.v, c.v), cluster) AS r
          FROM p, c{t} c) WHERE r = 1)""")
        if t < steps:
            out.append(f"""c{t + 1} AS MATERIALIZED (SELECT k, start, cluster, list(m ORDER BY pos) AS v FROM (SELECT k, start, cluster, pos,
              avg(x) AS m FROM (SELECT k, start, cluster, unnest(v) AS x, unnest(range(len(v))) AS pos FROM a{t}) GROUP BY ALL) GROUP BY ALL
              UNION ALL SELECT * FROM c{t} WHERE (k, start, cluster) NOT IN (SELECT (k, start, cluster) FROM a{t}))""")
    out += [
        f"costs AS (SELECT k, start, sum(d * d) AS cost FROM a{steps} GROUP BY 1, 2)",
        "chosen AS (SELECT k, start, cost FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY round(cost, 6), start) AS r "
        "FROM costs) WHERE r = 1)",
        f"best AS (SELECT k, key, v, cluster FROM a{steps} JOIN chosen USING (k, start))",
    ]
    return ",\n".join(out)


@query("kmeans_of_patterns_km1", f"{PATTERNS}, {lloyd_sql([4])} SELECT key AS branch_id, cluster FROM best")
def _(spark, d):
    grouped = clustering.kmeans_assign(pattern_points(spark, d), "branch_id", "v", [4], starts=STARTS, max_steps=STEPS)
    return grouped.select("branch_id", F.col("cluster_of4").alias("cluster"))


@query("elbow_curve_km2", f"{PATTERNS}, {lloyd_sql(range(2, 12))} SELECT k, cost AS inertia FROM chosen", "inertia", places=4)
def _(spark, d):
    return clustering.elbow_curve(pattern_points(spark, d), "branch_id", "v", range(2, 12), starts=STARTS, max_steps=STEPS)


def profile_points(spark, d):
    profile = joins.with_cluster(aggregates.site_profile(frames.ready(spark, d)))
    return profile.select("branch_id", "cluster_id", F.array("mean", "std", "max", "min").alias("v"))


@query(
    "silhouette_of_profiles_km3",
    f"""{HOURLY}, p AS (SELECT branch_id, any_value(cluster_id) AS l, [avg(heat_demand), stddev_samp(heat_demand),
      max(heat_demand), min(heat_demand)] AS v FROM ready r JOIN {CLUSTERS_SQL} ON r.branch_id = c.site GROUP BY 1),
    pair AS (SELECT x.branch_id, x.l, y.l AS l2, sum(list_distance(x.v, y.v)) AS s, count(*) AS n FROM p x, p y GROUP BY ALL),
    ab AS (SELECT branch_id, max(CASE WHEN l = l2 THEN s / nullif(n - 1, 0) END) AS a,
      min(CASE WHEN l <> l2 THEN s / n END) AS b, max(CASE WHEN l = l2 THEN n END) AS own FROM pair GROUP BY 1)
    SELECT avg(CASE WHEN own <= 1 THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM ab""",
    "silhouette",
)
def _(spark, d):
    return clustering.silhouette(profile_points(spark, d), "v", "cluster_id")


@query(
    "silhouette_by_k_km3",
    f"""{PATTERNS}, {lloyd_sql(range(2, 11))}, pair AS (SELECT x.k, x.key, x.cluster AS l, y.cluster AS l2, sum(list_distance(x.v, y.v)) AS s,
      count(*) AS n FROM best x JOIN best y USING (k) GROUP BY ALL),
    ab AS (SELECT k, key, max(CASE WHEN l = l2 THEN s / nullif(n - 1, 0) END) AS a,
      min(CASE WHEN l <> l2 THEN s / n END) AS b, max(CASE WHEN l = l2 THEN n END) AS own FROM pair GROUP BY 1, 2)
    SELECT k, avg(CASE WHEN own <= 1 THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM ab GROUP BY 1""",
    "silhouette",
)
def _(spark, d):
    grouped = clustering.kmeans_assign(pattern_points(spark, d), "branch_id", "v", range(2, 11), starts=STARTS, max_steps=STEPS)
    labels = [f"cluster_of{k}" for k in range(2, 11)]
    scores = clustering.silhouettes(grouped, "v", labels)
    return scores.select(F.regexp_extract("labels", "[0-9]+$", 0).cast("int").alias("k"), "silhouette")


LONG = "long AS (SELECT vec_id, label, unnest(range(1, 65)) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)"


@query(
    "squared_silhouette_of_embeddings_km3",
    f"""WITH {LONG}, pair AS (SELECT a.vec_id, a.label AS l, b.label AS l2, b.vec_id AS other,
      sum((a.x - b.x) * (a.x - b.x)) AS dist FROM long a JOIN long b ON a.pos = b.pos GROUP BY ALL),
    means AS (SELECT vec_id, l, l2, sum(dist) AS s, count(*) AS n FROM pair GROUP BY ALL),
    ab AS (SELECT vec_id, max(CASE WHEN l = l2 THEN s / nullif(n - 1, 0) END) AS a,
      min(CASE WHEN l <> l2 THEN s / n END) AS b, max(CASE WHEN l = l2 THEN n END) AS own FROM means GROUP BY 1)
    SELECT avg(CASE WHEN own <= 1 THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM ab""",
    "silhouette",
)
def _(spark, d):
    return clustering.squared_silhouette(frames.table(spark, d, "embeddings"), "embedding", "label")


@query(
    "dispersion_scores_of_embeddings_km4",
    f"""WITH {LONG}, cent AS (SELECT label, pos, avg(x) AS m, count(*) AS n FROM long GROUP BY 1, 2),
    grand AS (SELECT pos, avg(x) AS g FROM long GROUP BY 1),
    dist AS (SELECT vec_id, long.label, sum((x - m) * (x - m)) AS q FROM long JOIN cent USING (label, pos) GROUP BY 1, 2),
    w AS (SELECT sum(q) AS within, count(*) AS n, count(DISTINCT label) AS k FROM dist),
    b AS (SELECT sum(n * (m - g) * (m - g)) AS between_sum FROM cent JOIN grand USING (pos)),
    s AS (SELECT label, avg(sqrt(q)) AS s FROM dist GROUP BY 1),
    cc AS (SELECT a.label AS l1, b.label AS l2, sqrt(sum((a.m - b.m) * (a.m - b.m))) AS dist FROM cent a JOIN cent b
      ON a.pos = b.pos AND a.label <> b.label GROUP BY 1, 2),
    worst AS (SELECT l1, max((s1.s + s2.s) / dist) AS r FROM cc JOIN s s1 ON s1.label = l1 JOIN s s2 ON s2.label = l2 GROUP BY 1)
    SELECT (between_sum / (k - 1)) / (within / (n - k)) AS calinski_harabasz, (SELECT avg(r) FROM worst) AS davies_bouldin
    FROM w, b""",
    "calinski_harabasz davies_bouldin", places=5,
)
def _(spark, d):
    return clustering.dispersion_scores(frames.table(spark, d, "embeddings"), "embedding", "label")


def mean_vectors(spark, d):
    return materialise(clustering.mean_vectors(frames.table(spark, d, "embeddings"), "label", "embedding"))


#: centred Gram matrix of the means, squared until one axis is left; the second axis after taking the first out
def gram_axis_sql(name: str, gram: str, rounds: int = 14) -> str:
    steps = [f"{name}0 AS (SELECT i, j, g / (SELECT max(abs(g)) FROM {gram}) AS g FROM {gram})"]
    for t in range(rounds):
        steps.append(
            f"{name}{t}s AS MATERIALIZED (SELECT a.i, b.j, sum(a.g * b.g) AS g FROM {name}{t} a JOIN {name}{t} b ON a.j = b.i GROUP BY 1, 2), "
            f"{name}{t + 1} AS MATERIALIZED (SELECT i, j, g / (SELECT max(abs(g)) FROM {name}{t}s) AS g FROM {name}{t}s)"
        )
    last = f"{name}{rounds}"
    return ", ".join(steps) + (
        f", {name}u AS MATERIALIZED (SELECT i, g / sqrt((SELECT sum(g * g) FROM {last} WHERE j = (SELECT arg_max(i, g) FROM {last} WHERE i = j))) AS u "
        f"FROM {last} WHERE j = (SELECT arg_max(i, g) FROM {last} WHERE i = j))"
        f", {name}e AS (SELECT sum(a.u * g.g * b.u) AS e FROM {gram} g JOIN {name}u a ON a.i = g.i JOIN {name}u b ON b.i = g.j)"
        f", {name}p AS (SELECT i, u * sqrt(e) * sign((SELECT arg_max(u, round(abs(u), 9)) FROM {name}u)) AS p FROM {name}u, {name}e)"
    )


@query(
    "projection_of_mean_vectors_km5",
    f"""WITH long AS (SELECT label, unnest(range(1, 65)) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
    m AS (SELECT label, pos, avg(x) AS m FROM long GROUP BY 1, 2),
    c AS MATERIALIZED (SELECT label AS i, pos, m - avg(m) OVER (PARTITION BY pos) AS x FROM m),
    gram AS MATERIALIZED (SELECT a.i, b.i AS j, sum(a.x * b.x) AS g FROM c a JOIN c b USING (pos) GROUP BY 1, 2),
    {gram_axis_sql("f", "gram")},
    rest AS MATERIALIZED (SELECT g.i, g.j, g.g - a.u * b.u * (SELECT e FROM fe) AS g FROM gram g JOIN fu a ON a.i = g.i JOIN fu b ON b.i = g.j),
    {gram_axis_sql("s", "rest")}
    SELECT fp.i AS label, fp.p AS pc1, sp.p AS pc2 FROM fp JOIN sp USING (i)""",
    "pc1 pc2", places=5,
)
def _(spark, d):
    return clustering.project2(mean_vectors(spark, d), "embedding", ["label"])


@query("mean_vectors_km6", f"WITH {LONG} SELECT label, CAST(pos - 1 AS INT) AS pos, avg(x) AS m FROM long GROUP BY 1, 2", "m")
def _(spark, d):
    means = clustering.mean_vectors(frames.table(spark, d, "embeddings"), "label", "embedding")
    return means.select("label", F.posexplode("embedding").alias("pos", "m"))


@query(
    "kmeans_of_mean_vectors_km6",
    f"""WITH {LONG}, p AS MATERIALIZED (SELECT label AS key, list(m ORDER BY pos) AS v FROM (SELECT label, pos, avg(x) AS m FROM long
      GROUP BY 1, 2) GROUP BY 1), {lloyd_sql([3], seed=0)} SELECT key AS label, cluster FROM best""",
)
def _(spark, d):
    means = mean_vectors(spark, d)
    grouped = clustering.kmeans_assign(means, "label", "embedding", [3], starts=STARTS, max_steps=STEPS, seed=0)
    return grouped.select("label", F.col("cluster_of3").alias("cluster"))


@query(
    "cluster_members_km7",
    f"""{HOURLY} SELECT cluster_id, string_agg(DISTINCT branch_id, ',' ORDER BY branch_id) AS members,
    count(DISTINCT branch_id) AS size FROM ready r JOIN {CLUSTERS_SQL} ON r.branch_id = c.site GROUP BY 1""",
)
def _(spark, d):
    return clustering.members(joins.with_cluster(frames.ready(spark, d)), "cluster_id", "branch_id")
