"""Vector algebra, quality metrics, neighbours, density clustering, reduction, domains and terms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ticketloom.catalogue.model_queries import _long, _rounded
from ticketloom.catalogue.registry import query
from ticketloom.functions import vectors
from ticketloom.operators import cluster_stats, quality, terms

_KEYS = "tech_center, model_version"
# Pairwise distances of clustered points of the same model, for the comparison run.
_PAIRS = """pairs AS (SELECT a.tech_center, a.model_version, a.number, a.cluster_id AS c, b.cluster_id AS o,
    list_distance(a.embedding, b.embedding) AS d,
    1 - list_inner_product(a.embedding, b.embedding) / (sqrt(list_inner_product(a.embedding, a.embedding))
      * sqrt(list_inner_product(b.embedding, b.embedding))) AS cd
  FROM clustered a JOIN clustered b ON a.tech_center = b.tech_center AND a.model_version = b.model_version
    AND a.number <> b.number AND a.cluster_id <> -1 AND b.cluster_id <> -1)"""


def _silhouette_sql(d: str) -> str:
    return f"""WITH {_PAIRS}, means AS (SELECT {_KEYS}, number, c, o, avg({d}) AS m FROM pairs GROUP BY ALL),
      ab AS (SELECT {_KEYS}, number, max(m) FILTER (o = c) AS a, min(m) FILTER (o <> c) AS b FROM means GROUP BY ALL)
      SELECT {_KEYS}, round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette_score
      FROM ab GROUP BY ALL"""


_CENT = f"""dims AS (SELECT {_KEYS}, cluster_id, number, unnest(embedding) AS x, unnest(range(len(embedding))) AS i
    FROM clustered WHERE cluster_id <> -1),
  cent AS (SELECT {_KEYS}, cluster_id, i, avg(x) AS m, count(*) AS n, sum(x) AS sx FROM dims GROUP BY ALL),
  grand AS (SELECT {_KEYS}, i, sum(sx) / sum(n) AS g FROM cent GROUP BY ALL)"""


@query(
    "vector_distances",
    """SELECT a.number, b.number AS other, round(list_distance(a.embedding, b.embedding), 6) AS euclidean,
         round(1 - list_inner_product(a.embedding, b.embedding) / (sqrt(list_inner_product(a.embedding, a.embedding))
           * sqrt(list_inner_product(b.embedding, b.embedding))), 6) AS cosine FROM points a JOIN points b ON b.number = a.number + 1""",
)
def _(v):
    a = v.points
    b = v.points.select((F.col("number") - 1).alias("number"), F.col("number").alias("other"), F.col("embedding").alias("e"))
    x, y = F.col("embedding"), F.col("e")
    return a.join(b, "number").select(
        "number", "other", F.round(vectors.euclidean(x, y), 6).alias("euclidean"), F.round(vectors.cosine(x, y), 6).alias("cosine")
    )


@query(
    "standardized_vectors",
    """WITH d AS (SELECT number, tech_center, unnest(embedding) AS x, unnest(range(len(embedding))) AS dim FROM points),
       s AS (SELECT tech_center, dim, avg(x) AS m, stddev_pop(x) AS sd FROM d GROUP BY ALL)
       SELECT number, dim, round((x - m) / CASE WHEN sd > 0 THEN sd ELSE 1 END, 5) + 0.0 AS z FROM d JOIN s USING (tech_center, dim)""",
)
def _(v):
    z = vectors.standardize(v.points, ["tech_center"], "embedding")
    return z.select("number", F.posexplode("embedding").alias("dim", "z")).select(
        "number", F.col("dim").cast("long").alias("dim"), (F.round("z", 5) + 0.0).alias("z")
    )


@query(
    "weighted_vector_parts",
    """SELECT number, len(embedding) * 2 AS dims, round(list_sum(embedding) * 0.25 + list_sum(embedding) * 0.75, 6) AS total FROM points""",
)
def _(v):
    joined = vectors.weighted_concat([(F.col("embedding"), 0.25), (F.col("embedding"), 0.75)])
    return v.points.select(
        "number", F.size(joined).cast("long").alias("dims"), F.round(vectors.total(joined), 6).alias("total")
    )


@query(
    "dimension_moments",
    """SELECT tech_center, dim, count(*) AS n, round(avg(x), 6) + 0.0 AS mean, round(var_pop(x), 6) AS var_pop
       FROM (SELECT tech_center, unnest(embedding) AS x, unnest(range(len(embedding))) AS dim FROM points) GROUP BY ALL""",
)
def _(v):
    m = vectors.moments(v.points, ["tech_center"], "embedding")
    zipped = F.arrays_zip(F.col("mean").alias("m"), F.col("var_pop").alias("s"))
    return m.select("tech_center", "n", F.posexplode(zipped).alias("dim", "e")).select(
        "tech_center", F.col("dim").cast("long").alias("dim"), "n", (F.round("e.m", 6) + 0.0).alias("mean"),
        F.round("e.s", 6).alias("var_pop"),
    )


@query("clustering_matrix", "SELECT number, tech_center, len(embedding)::BIGINT AS dims FROM points")
def _(v):
    from pyspark.ml.functions import array_to_vector

    from ticketloom.operators import scans

    ready = scans.split_by_vector_validity(v.points, "embedding", 64).where("vector_status = 'ok'")
    vec = ready.withColumn("features", array_to_vector("embedding"))
    from pyspark.ml.functions import vector_to_array

    return vec.select("number", "tech_center", F.size(vector_to_array("features")).cast("long").alias("dims"))


@query(
    "variance_ratio",
    """WITH d AS (SELECT tech_center, unnest(embedding) AS x, unnest(range(len(embedding))) AS i FROM points),
       s AS (SELECT tech_center, i, var_pop(x) AS vp, count(*) AS n FROM d GROUP BY ALL)
       SELECT tech_center, max(n) AS n_samples, count(*) AS original_dimensions, 2::BIGINT AS reduced_dimensions,
         count(*) / 2 AS reduction_ratio, round(sum(vp) FILTER (i < 2) / sum(vp), 6) AS explained_variance_ratio FROM s GROUP BY 1""",
)
def _(v):
    rows = v.points.withColumn("reduced", F.slice("embedding", 1, 2))
    return _rounded(cluster_stats.variance_ratio(rows, "embedding", "reduced", ["tech_center"]), "explained_variance_ratio")


# --- quality ---------------------------------------------------------------------------------------------------------


@query("silhouette_euclidean", _silhouette_sql("d"))
def _(v):
    return _rounded(quality.silhouette_exact(v.clustered), "silhouette_score")


@query("silhouette_cosine", _silhouette_sql("cd"))
def _(v):
    return _rounded(quality.silhouette_linear(v.clustered), "silhouette_score")


_CH = f"""SELECT {_KEYS}, (sum(n * (m - g) * (m - g)) / (count(DISTINCT cluster_id) - 1)) AS b, count(DISTINCT cluster_id) AS k,
    sum(n) FILTER (i = 0) AS n FROM cent JOIN grand USING ({_KEYS}, i) GROUP BY ALL"""
_WITHIN = f"SELECT {_KEYS}, sum((x - m) * (x - m)) AS w FROM dims JOIN cent USING ({_KEYS}, cluster_id, i) GROUP BY ALL"


@query(
    "calinski_harabasz",
    f"""WITH {_CENT}, bt AS ({_CH}), wt AS ({_WITHIN})
        SELECT {_KEYS}, round(b / (w / (n - k)), 6) AS calinski_harabasz FROM bt JOIN wt USING ({_KEYS})""",
)
def _(v):
    return _rounded(quality.calinski_harabasz(v.clustered), "calinski_harabasz")


_DB = f"""{_CENT}, spread AS (SELECT {_KEYS}, cluster_id, avg(d) AS s FROM (SELECT {_KEYS}, cluster_id, number,
      sqrt(sum((x - m) * (x - m))) AS d FROM dims JOIN cent USING ({_KEYS}, cluster_id, i) GROUP BY ALL) GROUP BY ALL),
    gaps AS (SELECT a.tech_center, a.model_version, a.cluster_id AS ca, b.cluster_id AS cb, sqrt(sum((a.m - b.m) * (a.m - b.m))) AS d
      FROM cent a JOIN cent b ON a.tech_center = b.tech_center AND a.model_version = b.model_version AND a.i = b.i
      AND a.cluster_id <> b.cluster_id GROUP BY ALL),
    worst AS (SELECT g.tech_center, g.model_version, ca, max((sa.s + sb.s) / d) AS r FROM gaps g
      JOIN spread sa ON g.tech_center = sa.tech_center AND g.model_version = sa.model_version AND ca = sa.cluster_id
      JOIN spread sb ON g.tech_center = sb.tech_center AND g.model_version = sb.model_version AND cb = sb.cluster_id GROUP BY ALL)"""


@query(
    "davies_bouldin",
    f"WITH {_DB} SELECT {_KEYS}, round(avg(r), 6) AS davies_bouldin FROM worst GROUP BY ALL",
)
def _(v):
    return _rounded(quality.davies_bouldin(v.clustered), "davies_bouldin")


_SIL = _silhouette_sql("cd").replace("WITH ", "", 1)
_SIL_CTES, _SIL_BODY = _SIL.rsplit("SELECT tech_center, model_version, round(avg", 1)
_SIL_BODY = "SELECT tech_center, model_version, round(avg" + _SIL_BODY


@query(
    "quality_gate",
    f"""WITH {_SIL_CTES}, sil AS ({_SIL_BODY}), st AS (SELECT {_KEYS}, count(DISTINCT cluster_id) FILTER (cluster_id <> -1) AS k,
          count(*) FILTER (cluster_id = -1) / count(*) AS r FROM clustered GROUP BY ALL)
        SELECT {_KEYS}, NOT (k < 3 OR r > 0.3 OR silhouette_score < 0.15) AS passed,
          array_to_string(list_filter([CASE WHEN k < 3 THEN 'too_few_clusters' END, CASE WHEN r > 0.3 THEN 'too_much_noise' END,
            CASE WHEN silhouette_score < 0.15 THEN 'low_silhouette' END], lambda x: x IS NOT NULL), ',') AS reasons
        FROM st JOIN sil USING ({_KEYS})""",
)
def _(v):
    stats = cluster_stats.cluster_statistics(v.clustered).join(
        quality.silhouette_linear(v.clustered), ["tech_center", "model_version"]
    )
    return quality.gated(stats).select("tech_center", "model_version", "passed", F.array_join("reasons", ",").alias("reasons"))


@query(
    "degenerate_quality",
    """SELECT tech_center, model_version, 1::BIGINT AS n_clusters, 0.0::DOUBLE AS silhouette_score, 0.0::DOUBLE AS calinski_harabasz
       FROM clustered GROUP BY ALL""",
)
def _(v):
    one = v.clustered.withColumn("cluster_id", F.lit(0))
    return quality.analyse(one, degenerate="zero").select(
        "tech_center", "model_version", "n_clusters", "silhouette_score", "calinski_harabasz"
    )


_COMPARE_CTES = f"{_SIL_CTES}, sil AS ({_SIL_BODY})"


@query(
    "compare_versions",
    f"""WITH {_COMPARE_CTES}, st AS (SELECT {_KEYS}, count(DISTINCT cluster_id) FILTER (cluster_id <> -1) AS k,
          count(*) FILTER (cluster_id = -1) / count(*) AS r FROM clustered GROUP BY ALL),
        x AS (SELECT * FROM st JOIN sil USING ({_KEYS}))
        SELECT a.tech_center, '2024_q2' AS version1, '2024_q4' AS version2, b.k - a.k AS cluster_count_change,
          round(b.r - a.r, 6) AS noise_ratio_change,
          CASE WHEN b.silhouette_score > a.silhouette_score + 0.05 AND b.r < a.r THEN 'upgrade_recommended'
            WHEN b.silhouette_score < a.silhouette_score - 0.05 OR b.r > a.r + 0.1 THEN 'keep_previous_version'
            ELSE 'similar_performance' END AS recommendation
        FROM x a JOIN x b ON a.tech_center = b.tech_center AND a.model_version = '2024_q2' AND b.model_version = '2024_q4'""",
)
def _(v):
    from ticketloom.operators.lookups import compare_versions

    stats = cluster_stats.cluster_statistics(v.clustered).join(
        quality.silhouette_linear(v.clustered), ["tech_center", "model_version"]
    )
    return _rounded(compare_versions(stats, "2024_q2", "2024_q4").drop("quality_score_change"), "noise_ratio_change")


@query(
    "analysis_record",
    f"""WITH {_DB}, bt AS ({_CH}), wt AS ({_WITHIN}), {_SIL_CTES}, sil AS ({_SIL_BODY})
        SELECT {_KEYS}, silhouette_score, round(b / (w / (n - k)), 6) AS calinski_harabasz, k AS n_clusters,
          round((SELECT avg(r) FROM worst x WHERE x.tech_center = bt.tech_center AND x.model_version = bt.model_version), 6) AS davies_bouldin
        FROM bt JOIN wt USING ({_KEYS}) JOIN sil USING ({_KEYS})""",
)
def _(v):
    out = quality.analyse(v.clustered).select(
        "tech_center", "model_version", "silhouette_score", "calinski_harabasz", "n_clusters", "davies_bouldin"
    )
    return _rounded(out, "silhouette_score", "calinski_harabasz", "davies_bouldin")


@query(
    "analysis_report",
    f"""WITH {_DB}, bt AS ({_CH}), wt AS ({_WITHIN}), {_SIL_CTES}, sil AS ({_SIL_BODY}),
        st AS (SELECT {_KEYS}, count(*) FILTER (cluster_id = -1) AS noise, count(*) AS total FROM clustered GROUP BY ALL),
        db AS (SELECT {_KEYS}, avg(r) AS d FROM worst GROUP BY ALL)
        SELECT {_KEYS}, 'CLUSTER ANALYSIS REPORT' AS title, printf('- Number of Clusters: %d', k) AS clusters,
          printf('- Davies-Bouldin Score: %.3f', d) AS davies FROM bt JOIN wt USING ({_KEYS}) JOIN sil USING ({_KEYS})
          JOIN st USING ({_KEYS}) JOIN db USING ({_KEYS})""",
)
def _(v):
    stamped = quality.analyse(v.clustered).withColumn("analysis_timestamp", F.to_timestamp(F.lit("2024-12-31 12:00:00")))
    lines = F.split(F.col("report"), "\n")
    return cluster_stats.analysis_report(stamped).select(
        "tech_center", "model_version", lines[0].alias("title"), lines[7].alias("clusters"), lines[14].alias("davies")
    )


# --- terms -----------------------------------------------------------------------------------------------------------

_TOK = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]{{2,}}')"
_VOCAB = f"vocab AS (SELECT DISTINCT unnest({_TOK.format('text')}) AS term FROM benchmark)"


def _vocabulary(v):
    return terms.term_counts(v.table("benchmark"), [], "text").select("term")


@query(
    "dictionary_terms",
    f"""WITH {_VOCAB}, t AS (SELECT unnest({_TOK.format('text')}) AS term FROM documents)
        SELECT class, term, n AS frequency FROM (SELECT CASE WHEN length(term) % 2 = 0 THEN 'ENTITY' ELSE 'ACTION' END AS class, term,
          count(*) AS n FROM t WHERE term IN (SELECT term FROM vocab) GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY class ORDER BY n DESC, term) <= 50""",
)
def _(v):
    dictionary = _vocabulary(v).withColumn("class", F.when(F.length("term") % 2 == 0, "ENTITY").otherwise("ACTION"))
    return terms.dictionary_frequencies(v.table("documents"), "text", dictionary)


@query(
    "tf_idf",
    f"""WITH {_VOCAB}, t AS (SELECT doc_id, unnest({_TOK.format('text')}) AS term FROM documents),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM vocab) GROUP BY ALL),
        idf AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf FROM tf GROUP BY term)
        SELECT doc_id, term, round(tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)), 6) AS weight
        FROM tf JOIN idf USING (term)""",
)
def _(v):
    return _rounded(terms.tf_idf(v.table("documents"), "doc_id", "text", _vocabulary(v)), "weight")


@query(
    "cluster_keyword_labels",
    f"""WITH t AS (SELECT lang, doc_id % 7 AS cluster_id, unnest({_TOK.format('text')}) AS term FROM documents),
        c AS (SELECT lang, cluster_id, term, count(*) AS tf FROM t GROUP BY ALL),
        a AS (SELECT lang, sum(tf) / count(DISTINCT cluster_id) AS av FROM c GROUP BY ALL),
        f AS (SELECT lang, term, sum(tf) AS total FROM c GROUP BY ALL),
        r AS (SELECT lang, cluster_id, term, row_number() OVER (PARTITION BY lang, cluster_id
          ORDER BY round(tf * ln(1 + av / total), 9) DESC, term) AS rn FROM c JOIN a USING (lang) JOIN f USING (lang, term))
        SELECT lang, cluster_id, string_agg(term, ' ' ORDER BY rn) AS primary_label FROM r WHERE rn <= 3 GROUP BY ALL""",
)
def _(v):
    docs = v.table("documents").withColumn("cluster_id", F.col("doc_id") % 7)
    return terms.label_clusters(docs, ["lang"], "text").select("lang", "cluster_id", "primary_label")


# --- neighbours and density ------------------------------------------------------------------------------------------

_NN = """nn AS (SELECT a.tech_center, a.number, b.number AS neighbour, list_distance(a.embedding, b.embedding) AS d,
    row_number() OVER (PARTITION BY a.number ORDER BY list_distance(a.embedding, b.embedding), b.number) AS rank
  FROM points a JOIN points b ON a.tech_center = b.tech_center AND a.number <> b.number)"""


def _shared(v, name, make):
    """Results that several queries look at are computed once per set of views."""
    memo = v.__dict__.setdefault("_memo", {})
    if name not in memo:
        memo[name] = make()
    return memo[name]


def _nn(v):
    from ticketloom.operators import neighbours
    from ticketloom.runtime import cut

    return _shared(v, "nn", lambda: cut(neighbours.neighbours(v.points, ["tech_center"], "number", "embedding", 10)))


@query(
    "nearest_neighbours",
    f"WITH {_NN} SELECT number, neighbour, rank, round(d, 6) AS distance FROM nn WHERE rank <= 10",
)
def _(v):
    return _rounded(_long(_nn(v), "rank"), "distance").drop("tech_center")


@query(
    "nearest_neighbours_cosine",
    f"""WITH {_NN.replace("list_distance(a.embedding, b.embedding) AS d", "1 - list_inner_product(a.embedding, b.embedding) / (sqrt(list_inner_product(a.embedding, a.embedding)) * sqrt(list_inner_product(b.embedding, b.embedding))) AS d").replace("ORDER BY list_distance(a.embedding, b.embedding)", "ORDER BY d")}
        SELECT number, neighbour, rank, round(d, 6) AS distance FROM nn WHERE rank <= 3""",
)
def _(v):
    from ticketloom.operators import neighbours

    nn = neighbours.neighbours(v.points, ["tech_center"], "number", "embedding", 3, "cosine")
    return _rounded(_long(nn, "rank"), "distance").drop("tech_center")


@query("core_distances", f"WITH {_NN} SELECT number, round(d, 6) AS core_distance FROM nn WHERE rank = 5")
def _(v):
    from ticketloom.operators import neighbours

    return _rounded(neighbours.core_distances(_nn(v), ["tech_center"], "number", 5), "core_distance").drop("tech_center")


@query(
    "reachability_edges",
    f"""WITH {_NN.replace("nn AS (", "nn AS MATERIALIZED (", 1)[:-1]} QUALIFY rank <= 10), core AS (SELECT number, d AS c FROM nn WHERE rank = 5)
        SELECT nn.number, neighbour, round(greatest(a.c, b.c, d), 6) AS reachability FROM nn JOIN core a ON nn.number = a.number
        JOIN core b ON neighbour = b.number WHERE rank <= 10""",
)
def _(v):
    from ticketloom.operators import neighbours

    cores = neighbours.core_distances(_nn(v), ["tech_center"], "number", 5)
    edges = neighbours.reachability_edges(_nn(v), cores, ["tech_center"], "number")
    return _rounded(edges, "reachability").drop("tech_center")


@query("local_scale", f"WITH {_NN} SELECT number, round(d, 6) AS rho FROM nn WHERE rank = 1")
def _(v):
    from ticketloom.operators import neighbours

    return _rounded(neighbours.local_scale(_nn(v), ["tech_center"], "number"), "rho").drop("tech_center")


@query("fuzzy_graph")
def _(v):
    from ticketloom.operators import neighbours

    return _rounded(neighbours.fuzzy_graph(_nn(v), ["tech_center"], "number", 10), "weight")


MIN_SIZE, SAMPLES = 5, 3


def _tree(v):
    from ticketloom.operators import density

    return _shared(
        v, "tree", lambda: density.spanning_tree(v.points, ["tech_center"], "number", "embedding", SAMPLES)
    )


@query("spanning_tree")
def _(v):
    from ticketloom.operators import density

    return _rounded(density.tree_edges(_tree(v), ["tech_center"]), "w")


_EPS = 1.12
_FLAT = f"""RECURSIVE {_NN}, core AS (SELECT number, d AS c FROM nn WHERE rank = {SAMPLES}),
  e AS (SELECT nn.number AS a, neighbour AS b FROM nn JOIN core x ON nn.number = x.number JOIN core y ON neighbour = y.number
        WHERE greatest(x.c, y.c, d) <= {_EPS}),
  reach(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a),
  comp AS (SELECT a AS number, least(a, min(b)) AS comp FROM reach GROUP BY a),
  sized AS (SELECT tech_center, comp, count(*) AS n FROM comp JOIN points USING (number) GROUP BY ALL HAVING count(*) >= {MIN_SIZE}),
  ids AS (SELECT comp, row_number() OVER (PARTITION BY tech_center ORDER BY n DESC, comp) - 1 AS cluster_id FROM sized)"""


@query(
    "flat_cut",
    f"""WITH {_FLAT} SELECT p.number, coalesce(cluster_id, -1)::BIGINT AS cluster_id FROM points p LEFT JOIN comp USING (number)
        LEFT JOIN ids USING (comp)""",
)
def _(v):
    from ticketloom.operators import density

    out = density.flat_cut(_tree(v), ["tech_center"], "number", _EPS, MIN_SIZE)
    return _long(out.select("number", "cluster_id"), "cluster_id")


def _model(v):
    from ticketloom.operators import density
    from ticketloom.runtime import cut

    def make():
        h = density.hierarchy(_tree(v), MIN_SIZE)
        return h, cut(density.assignments(_tree(v), h, ["tech_center"], "number"))

    return _shared(v, "model", make)


@query("density_clusters")
def _(v):
    return _rounded(_model(v)[1], "probability", "lambda", "outlier_score", "core_distance")


@query("cluster_hierarchy")
def _(v):
    return _model(v)[0].clusters.select(
        F.col("_k").alias("tech_center"), F.to_json("cluster").alias("cluster"), F.to_json("parent").alias("parent"),
        F.round("birth", 6).alias("birth"), F.round("death", 6).alias("death"), F.round("stability", 6).alias("stability"),
        "size", "selected",
    )


@query("predict_clusters")
def _(v):
    from ticketloom.operators import density

    trained = v.points.join(_model(v)[1], ["tech_center", "number"])
    fresh = v.points.withColumn("number", F.col("number") + 1_000_000).withColumn(
        "embedding", F.transform("embedding", lambda x: x * 0.99)
    )
    out = density.predict(fresh, trained, ["tech_center"], "number", "embedding", SAMPLES)
    return _rounded(out, "strength", "distance")


@query("reduce_dimensions")
def _(v):
    from ticketloom.operators import reduction

    model = reduction.fit_components(v.points, ["tech_center"], "embedding")
    out = reduction.project(v.points, model, ["tech_center"], "embedding")
    return _rounded(out.select("number", "tech_center", "umap_x", "umap_y"), "umap_x", "umap_y", digits=5)


@query("reducer_parameters")
def _(v):
    from ticketloom.operators import reduction

    return reduction.parameters(reduction.fit_components(v.points, ["tech_center"], "embedding"), ["tech_center"])


@query("domain_groups")
def _(v):
    from ticketloom.operators import domains

    keys = ["tech_center", "model_version"]
    return domains.group_domains(cluster_stats.planar_centers(v.clustered), keys)


# Ward merging in SQL: in every step the nearest pair of groups of a key is merged, ties by the smallest names
_WARD = f"""RECURSIVE centres AS (
    SELECT {_KEYS}, cluster_id::BIGINT AS cluster_id, avg(umap_x) AS x, avg(umap_y) AS y FROM clustered WHERE cluster_id <> -1 GROUP BY ALL),
  s AS (
    SELECT {_KEYS}, 0::BIGINT AS step, NULL::BIGINT AS a, NULL::BIGINT AS b, NULL::DOUBLE AS d2,
      list({{'id': cluster_id, 'n': 1.0::DOUBLE, 'x': x, 'y': y, 'm': [cluster_id]}} ORDER BY cluster_id) AS g
    FROM centres GROUP BY {_KEYS}
    UNION ALL
    SELECT {_KEYS}, step + 1, p.a, p.b, p.d2,
      list_concat(list_filter(g, lambda e: e.id <> p.a AND e.id <> p.b),
        [{{'id': p.a, 'n': p.i.n + p.j.n, 'x': (p.i.n * p.i.x + p.j.n * p.j.x) / (p.i.n + p.j.n),
           'y': (p.i.n * p.i.y + p.j.n * p.j.y) / (p.i.n + p.j.n), 'm': list_concat(p.i.m, p.j.m)}}])
    FROM (SELECT *, list_sort(flatten(list_transform(g, lambda i: list_transform(list_filter(g, lambda j: j.id > i.id),
        lambda j: {{'d2': 2 * i.n * j.n / (i.n + j.n) * ((i.x - j.x) ** 2 + (i.y - j.y) ** 2), 'a': i.id, 'b': j.id, 'i': i, 'j': j}}))))[1] AS p
      FROM s WHERE len(g) > 1))"""


@query("ward_merges", f"WITH {_WARD} SELECT {_KEYS}, step, a, b, round(sqrt(d2), 6) AS height FROM s WHERE step > 0")
def _(v):
    from ticketloom.operators import ward

    keys = ["tech_center", "model_version"]
    rows = cluster_stats.planar_centers(v.clustered).select(*keys, "cluster_id", F.array("center_x", "center_y").alias("v"))
    return _rounded(_long(ward.merge_table(rows, keys, "cluster_id", "v"), "step", "a", "b"), "height")


@query(
    "domain_groups_scored",
    f"""WITH {_WARD}, n AS (SELECT {_KEYS}, count(*) AS n FROM centres GROUP BY ALL),
      parts AS (SELECT {_KEYS}, n - step AS want, n, unnest(g) AS e FROM s JOIN n USING ({_KEYS})
        WHERE n > 3 AND n - step BETWEEN 2 AND greatest(2, least(15, n - 1))),
      labels AS (SELECT {_KEYS}, want, n, unnest(e.m) AS cluster_id,
        dense_rank() OVER (PARTITION BY {_KEYS}, want ORDER BY list_min(e.m)) - 1 AS domain_id FROM parts),
      l AS (SELECT * FROM labels JOIN centres USING ({_KEYS}, cluster_id)),
      sums AS (SELECT a.tech_center, a.model_version, a.want, a.cluster_id, a.domain_id, b.domain_id AS other,
          sum(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2)) AS t, count(*) AS m
        FROM l a JOIN l b ON a.tech_center = b.tech_center AND a.model_version = b.model_version AND a.want = b.want GROUP BY ALL),
      own AS (SELECT {_KEYS}, want, cluster_id, max(m) FILTER (other = domain_id) AS size,
          max(t / greatest(m - 1, 1)) FILTER (other = domain_id) AS a, min(t / m) FILTER (other <> domain_id) AS b FROM sums GROUP BY ALL),
      sil AS (SELECT {_KEYS}, want, avg(CASE WHEN size = 1 THEN 0.0 ELSE (b - a) / greatest(a, b) END) AS sil FROM own GROUP BY ALL),
      mid AS (SELECT {_KEYS}, want, domain_id, avg(x) AS mx, avg(y) AS my, count(*) AS c FROM l GROUP BY ALL),
      grand AS (SELECT {_KEYS}, want, avg(x) AS gx, avg(y) AS gy FROM l GROUP BY ALL),
      between_ AS (SELECT {_KEYS}, want, sum(c * ((mx - gx) ** 2 + (my - gy) ** 2)) AS ssb FROM mid JOIN grand USING ({_KEYS}, want) GROUP BY ALL),
      within_ AS (SELECT {_KEYS}, want, any_value(n) AS n, sum((x - mx) ** 2 + (y - my) ** 2) AS ssw
        FROM l JOIN mid USING ({_KEYS}, want, domain_id) GROUP BY ALL),
      score AS (SELECT {_KEYS}, want, n, sil + ch / (1000 + ch) AS score FROM (
        SELECT {_KEYS}, want, n, sil, (ssb / (want - 1)) / (ssw / (n - want)) AS ch
        FROM sil JOIN between_ USING ({_KEYS}, want) JOIN within_ USING ({_KEYS}, want))),
      best AS (SELECT {_KEYS}, coalesce(arg_min(want, (-score, want)) FILTER (score > 0), least(15, greatest(2, any_value(n) // 5))) AS want
        FROM score GROUP BY ALL)
      SELECT {_KEYS}, cluster_id, domain_id, want AS domain_count FROM labels JOIN best USING ({_KEYS}, want)
      UNION ALL SELECT {_KEYS}, cluster_id, 0, 1 FROM centres JOIN n USING ({_KEYS}) WHERE n <= 3""",
)
def _(v):
    from ticketloom.operators import domains

    keys = ["tech_center", "model_version"]
    out = domains.group_domains_scored(cluster_stats.planar_centers(v.clustered), keys)
    return _long(out.select(*keys, "cluster_id", "domain_id", "domain_count"), "cluster_id", "domain_id", "domain_count")


# customers of a nation in a ring by account balance: its eigenvalues are known, the leading one comes twice
@query(
    "ring_spectrum",
    """SELECT c_nationkey, c::BIGINT AS component, round(cos(2 * pi() / count(*)), 3) AS eigenvalue, true AS settled
       FROM customer, range(0, 2) AS r(c) GROUP BY c_nationkey, c HAVING count(*) > 2""",
)
def _(v):
    from pyspark.sql import Window

    from ticketloom.operators import spectral

    order = Window.partitionBy("c_nationkey").orderBy("c_acctbal", "c_custkey")
    size = F.count("*").over(Window.partitionBy("c_nationkey"))
    rows = v.table("customer").select("c_nationkey", "c_custkey", size.alias("n"), F.coalesce(
        F.lead("c_custkey").over(order), F.first("c_custkey").over(order)).alias("next")).where("n > 2")
    found = spectral.eigenvectors(rows.withColumn("w", F.lit(1.0)), ["c_nationkey"], "c_custkey", "next", "w", "c_custkey", tolerance=1e-4)
    out = found.values.select("c_nationkey", "component", "eigenvalue", (F.col("residual") <= 1e-4).alias("settled"))
    return _rounded(_long(out, "component"), "eigenvalue", digits=3)


@query("graph_layout")
def _(v):
    from ticketloom.operators import neighbours, reduction

    graph = neighbours.fuzzy_graph(_nn(v), ["tech_center"], "number", 10)
    placed, spectrum = reduction.graph_layout(graph, ["tech_center"], "number")
    out = placed.select("tech_center", "number", "umap_x", "umap_y")
    return _rounded(out, "umap_x", "umap_y", digits=3)


@query(
    "domain_names",
    f"""SELECT {_KEYS}, domain_id::BIGINT AS domain_id, cluster_id::BIGINT AS cluster_id, 'Domain ' || domain_id || ': Topic ' ||
          min(cluster_id) OVER (PARTITION BY {_KEYS}, domain_id) AS domain_name FROM domain_map
        UNION ALL SELECT DISTINCT {_KEYS}, -1, -1, 'Noise' FROM domain_map""",
)
def _(v):
    from ticketloom.operators import domains

    labels = v.domain_map.withColumn("topic", F.concat(F.lit("Topic "), "cluster_id"))
    out = domains.name_domains(v.domain_map, labels, ["tech_center", "model_version"])
    return _long(out.drop("domain_description"), "domain_id", "cluster_id")


@query("smooth_layout")
def _(v):
    from ticketloom.operators import neighbours, reduction

    keys = ["tech_center"]
    layout = reduction.project(v.points, reduction.fit_components(v.points, keys, "embedding"), keys, "embedding")
    graph = neighbours.fuzzy_graph(_nn(v), keys, "number", 10)
    out = reduction.smooth(layout.drop("embedding"), graph, keys, "number", rounds=2)
    return _rounded(out.select("number", "tech_center", "umap_x", "umap_y"), "umap_x", "umap_y", digits=5)


@query(
    "embed_texts",
    f"""SELECT doc_id, CASE WHEN length(trim(text, E' \\n\\t\\r')) // 4 > 8191 THEN 'long' ELSE 'valid' END AS embedding_status, 64::BIGINT AS dims,
          CASE WHEN len({_TOK.format('text')}) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS length FROM documents""",
)
def _(v):
    from ticketloom.functions import providers

    done = providers.embed(v.table("documents"), "text", dims=64)
    return done.select(
        "doc_id", "embedding_status", F.size("embedding").cast("long").alias("dims"),
        F.round(vectors.norm(F.col("embedding")), 6).alias("length"),
    )


@query("complete_analysis")
def _(v):
    from ticketloom.plans import train

    points = v.clustered.withColumn("reduced", F.array("umap_x", "umap_y"))
    keys = ["tech_center", "model_version"]
    out = train.complete_analysis(points, train.TrainingOptions(), keys)["labelled"]
    return out.select(*keys, "number", "cluster_id", "cluster_label", "domain_id", "domain_name")
