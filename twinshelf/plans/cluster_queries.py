"""Queries: similarity joins, hierarchical clusters, k-means, catalogue matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import centroids, linkage, similarity
from ..operators import vectors as v
from ..operators.selection import copies
from ..session import release, stage
from ..sources.tables import keyed_update
from .catalogues import Matcher
from .registry import PRODUCTS, catalogues, products, query, table
from .text_queries import (
    _TERMS,
    DOCUMENT_TERMS,
    DOCUMENT_WEIGHTING,
    _tidy_sql,
    document_texts,
)
from .titles import (
    TitleTerms,
    assignments,
    cluster_titles,
    distinct_titles,
    text_of_records,
)


def _title_vectors(spark, folder, weighting=v.LABELLED_WEIGHTING):
    """The distinct vectors of the product titles with their record counts."""
    terms = TitleTerms()
    texts = stage(distinct_titles(products(spark, folder), "product_id", "title", terms),
                  "titles")
    grams = text.ngrams(text.word_tokens(F.col("title")), (1, 3))
    sparse, _ = v.vectors(texts, grams, weighting)
    return v.distinct_vectors(sparse, texts, ["vector"])[1]


_TITLE_VECTORS = f"""{PRODUCTS}, {_TERMS},
kept AS (SELECT term, ln((1 + n) / (1 + df)) + 1 AS idf
         FROM vocabulary, (SELECT count(*) AS n FROM products)
         WHERE df >= 0.05 * n AND df <= 0.6 * n),
marks AS (SELECT product_id, string_agg(term || '=' || tf, ',' ORDER BY term) AS mark
          FROM counts JOIN kept USING (term) GROUP BY product_id),
reps AS (SELECT mark, min(product_id) AS id, count(*) AS copies FROM marks GROUP BY mark),
raw AS (SELECT id, term, tf * idf AS w FROM reps JOIN counts ON product_id = id
        JOIN kept USING (term)),
weights AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM raw)"""


def _profiles_sql(entry: str) -> str:
    """Rows of the similarity matrix as lists; ``entry`` makes a list's entry of ``s``."""
    return f"""
s AS (SELECT a.id AS x, b.id AS y, sum(a.weight * b.weight) AS s
      FROM weights a JOIN weights b USING (term) GROUP BY a.id, b.id),
kept_ids AS (SELECT DISTINCT id FROM weights),
whole AS (SELECT i.id AS x, list({entry} * sqrt(copies) ORDER BY j.id) AS l
          FROM kept_ids i CROSS JOIN kept_ids j JOIN reps ON reps.id = j.id
          LEFT JOIN s ON s.x = i.id AND s.y = j.id GROUP BY i.id),
p AS MATERIALIZED (SELECT u.x AS a, w.x AS b, list_cosine_similarity(u.l, w.l) AS sim
                   FROM whole u JOIN whole w ON u.x < w.x)"""


def _pairs_sql(at_least: float) -> str:
    return f"""
SELECT a.id AS a, b.id AS b, sum(a.weight * b.weight) AS sim
FROM weights a JOIN weights b USING (term) WHERE a.id < b.id
GROUP BY a.id, b.id HAVING sum(a.weight * b.weight) >= {at_least} - 1e-12"""


@query(f"""
WITH {_TITLE_VECTORS}, pairs AS ({_pairs_sql(0.4)})
SELECT a, b, round(sim, 6) AS sim FROM pairs
""")
def cosine_pairs(spark, folder):
    one = _title_vectors(spark, folder)
    return similarity.cosine_pairs(one, 0.4).withColumn("sim", F.round("sim", 6))


@query(f"""
WITH {DOCUMENT_TERMS}, pairs AS ({_pairs_sql(0.7)})
SELECT a, b, round(sim, 6) AS sim FROM pairs
""")
def cosine_pairs_documents(spark, folder):
    texts, terms = document_texts(spark, folder)
    texts = stage(texts, "texts")
    sparse, _ = v.vectors(texts, terms, DOCUMENT_WEIGHTING)
    release(texts)
    pairs = similarity.cosine_pairs(sparse, 0.7)
    release(sparse)  # the pairs are found from its blocks
    return pairs.withColumn("sim", F.round("sim", 6))


@query(f"""
WITH {PRODUCTS},
texts AS (SELECT name, brand, min(product_id) AS id, count(*) AS copies FROM products
          GROUP BY ALL),
n AS (SELECT count(*) AS n FROM products),
split AS (SELECT id AS product_id, list_filter(string_split(lower(
            regexp_replace(name, '([0-9])([A-Za-z])', '\\1 \\2', 'g')), ' '),
            lambda w: w NOT IN ('sale', 'model', 'freeship')) AS t, copies FROM texts),
grams AS (
  SELECT product_id AS id, copies, t[i] AS term FROM split, range(1, len(t) + 1) r(i)
  UNION ALL
  SELECT product_id, copies, t[i] || ' ' || t[i + 1] FROM split, range(1, len(t)) r(i)
  UNION ALL
  SELECT product_id, copies, t[i] || ' ' || t[i + 1] || ' ' || t[i + 2]
  FROM split, range(1, len(t) - 1) r(i)),
counts AS (
  SELECT 'title' AS feature, id, copies, term, count(*) AS tf FROM grams GROUP BY ALL
  UNION ALL
  SELECT 'brand', id, copies, lower(brand), 1 FROM texts),
kept AS (
  SELECT feature, term, ln((1 + n) / (1 + df)) + 1 AS idf
  FROM (SELECT feature, term, sum(copies) AS df FROM counts GROUP BY ALL), n
  WHERE df >= 0.01 * n AND df <= 0.7 * n),
raw AS (SELECT feature, id, term, tf * idf AS w FROM counts JOIN kept USING (feature, term)),
weights AS (SELECT feature, id, term, w / sqrt(sum(w * w) OVER (PARTITION BY feature, id))
            AS weight FROM raw),
pairs AS (
  SELECT a.id AS a, b.id AS b, sum(0.5 * a.weight * b.weight) AS sim
  FROM weights a JOIN weights b USING (feature, term) WHERE a.id < b.id GROUP BY a.id, b.id)
SELECT a, b, round(sim, 6) AS sim FROM pairs WHERE sim >= 0.58 - 1e-12
""")
def weighted_pairs(spark, folder):
    matcher = Matcher()
    rows = products(spark, folder)
    texts = stage(
        copies(rows.select("name", "brand", "product_id")
               .withColumnRenamed("name", "title"), ["title", "brand"], "product_id"),
        "texts",
    )
    wide = matcher.feature_vectors(texts)
    weights = {f.name: f.weight for f in matcher.features}
    return similarity.weighted_pairs(wide, weights, 0.58).withColumn("sim", F.round("sim", 6))


@query(f"""
WITH {_TITLE_VECTORS},
{_profiles_sql('coalesce(s, 0)')}
SELECT a, b, round(sim, 6) AS sim FROM p WHERE sim >= 0.75 - 1e-12
""")
def profile_cosine(spark, folder):
    one = _title_vectors(spark, folder)
    profiles = similarity.profile_vectors(one.select("id", "vector"), one.select("id", "copies"))
    return similarity.profile_pairs(profiles, 0.75).withColumn("sim", F.round("sim", 6))


def _merged_sql(sims: str, within: str, average: bool = False) -> str:
    """Complete linkage one merge at a time: the closest pair of clusters, ties by hash.

    ``sims`` (a, b, sim) has the pairs of ids, ``reps`` all ids with their record counts, which
    average linkage weighs the pairs by.
    """
    if average:
        near = """near AS MATERIALIZED (SELECT a, b, sim * x.copies * y.copies AS d
  FROM sims JOIN reps x ON x.id = a JOIN reps y ON y.id = b)"""
        distance = "round(1 - sum(d) / any_value(x.n * y.n), 12)"
        size, having = "sum(copies)", f"{distance} {within}"
        state = "state JOIN reps USING (id)"
    else:
        near = f"""near AS MATERIALIZED (
  SELECT a, b, round(1 - sim, 12) AS d FROM sims WHERE round(1 - sim, 12) {within})"""
        distance, size, state = "max(d)", "count(*)", "state"
        having = "count(*) = any_value(x.n * y.n)"
    return f"""
sims AS ({sims}),
{near},
state(step, id, cluster, distance, gone, kept) AS (
  SELECT 0, id, id, NULL::DOUBLE, NULL::BIGINT, NULL::BIGINT FROM reps
  UNION ALL
  SELECT step + 1, s.id, CASE WHEN s.cluster = m.b THEN m.a ELSE s.cluster END, m.d, m.b, m.a
  FROM state s, (SELECT * FROM (
    SELECT least(u.cluster, w.cluster) AS a, greatest(u.cluster, w.cluster) AS b, {distance} AS d
    FROM near p JOIN state u ON u.id = p.a JOIN state w ON w.id = p.b
    JOIN (SELECT cluster, {size} AS n FROM {state} GROUP BY 1) x ON x.cluster = u.cluster
    JOIN (SELECT cluster, {size} AS n FROM {state} GROUP BY 1) y ON y.cluster = w.cluster
    WHERE u.cluster <> w.cluster GROUP BY 1, 2 HAVING {having})
    ORDER BY d, md5(concat_ws('-', a::VARCHAR, b::VARCHAR)), a, b LIMIT 1) m),
merged AS (SELECT id, cluster FROM state WHERE step = (SELECT max(step) FROM state))"""


_LISTED = f"""
tidy AS (SELECT product_id, cluster_id, {_tidy_sql('title')} AS title FROM products),
firsts AS (SELECT title, min(product_id) AS text FROM tidy GROUP BY title)
SELECT product_id AS id, cluster_id, coalesce(cluster, text) AS new_cluster, title
FROM tidy JOIN firsts USING (title) LEFT JOIN marks USING (product_id)
LEFT JOIN reps USING (mark) LEFT JOIN merged ON merged.id = reps.id
"""


def _listed(spark, folder, **how):
    rows = products(spark, folder)
    found = cluster_titles(rows, "product_id", "title", **how)
    return assignments(rows, "product_id", "title", found, carry=["cluster_id"])


@query(f"""
WITH RECURSIVE {_TITLE_VECTORS}, {_merged_sql(_pairs_sql(0.12), '< 0.88')}, {_LISTED}
""")
def cluster_complete(spark, folder):
    return _listed(spark, folder, cut=0.88)


@query(f"""
WITH RECURSIVE {_TITLE_VECTORS}, {_merged_sql(_pairs_sql(0.35), '<= 0.65')}, {_LISTED}
""")
def cluster_direct(spark, folder):
    return _listed(spark, folder, cut=0.65, inclusive=True)


@query()  # some 1,700 merges at sf0.01: minutes in SQL
def cluster_profile(spark, folder):
    return _listed(spark, folder, cut=0.25, inclusive=True, space="profile",
                   weighting=v.TITLE_WEIGHTING)


@query(f"""
WITH RECURSIVE {_TITLE_VECTORS}, {_profiles_sql('(1 - coalesce(s, 0))')},
{_merged_sql('FROM p', '<= 0.008', average=True)}, {_LISTED}
""")
def cluster_average(spark, folder):
    return _listed(spark, folder, cut=0.008, inclusive=True, method="average",
                   space="distance profile")


def _kruskal_sql(sims: str, within: str) -> str:
    """Single linkage one merge at a time: the least pair of ids in different clusters."""
    return f"""
sims AS ({sims}),
near AS MATERIALIZED (
  SELECT a, b, round(1 - sim, 12) AS d, md5(concat_ws('-', a::VARCHAR, b::VARCHAR)) AS tie
  FROM sims WHERE round(1 - sim, 12) {within}),
state(step, id, cluster, distance, gone, kept) AS (
  SELECT 0, id, id, NULL::DOUBLE, NULL::BIGINT, NULL::BIGINT FROM reps
  UNION ALL
  SELECT step + 1, s.id, CASE WHEN s.cluster = m.b THEN m.a ELSE s.cluster END, m.d, m.b, m.a
  FROM state s, (
    SELECT least(u.cluster, w.cluster) AS a, greatest(u.cluster, w.cluster) AS b, p.d
    FROM near p JOIN state u ON u.id = p.a JOIN state w ON w.id = p.b
    WHERE u.cluster <> w.cluster ORDER BY p.d, p.tie, p.a, p.b LIMIT 1) m),
merged AS (SELECT id, cluster FROM state WHERE step = (SELECT max(step) FROM state))"""


_STEPS = """
steps AS (SELECT DISTINCT step, distance, kept, gone FROM state WHERE step > 0),
sizes AS (SELECT step, cluster, sum(copies) AS size FROM state JOIN reps USING (id) GROUP BY ALL)
SELECT steps.step::BIGINT AS step, kept AS "left", gone AS "right", round(distance, 6) AS distance,
       size::BIGINT AS size
FROM steps JOIN sizes ON steps.step = sizes.step AND sizes.cluster = steps.kept
"""


def _single(spark, folder, **how):
    return cluster_titles(products(spark, folder), "product_id", "title", method="single tree",
                          inclusive=True, **how)


def _numbered(merges):
    return merges.select(F.col("round").cast("long").alias("step"), "left", "right",
                         F.round("distance", 6).alias("distance"), "size")


@query(f"""
WITH RECURSIVE {_TITLE_VECTORS}, {_kruskal_sql(_pairs_sql(0.35), '<= 0.65')}, {_STEPS}
""")
def merge_tree_single(spark, folder):
    """The merges of single linkage on cosine distance."""
    return _numbered(_single(spark, folder, cut=0.65).merges)


@query(f"""
WITH RECURSIVE {_TITLE_VECTORS}, {_profiles_sql('coalesce(s, 0)')},
{_kruskal_sql('FROM p', '<= 0.25')}, {_STEPS}
""")
def merge_tree_single_profile(spark, folder):
    """The merges of single linkage on rows of the similarity matrix."""
    return _numbered(_single(spark, folder, cut=0.25, space="profile").merges)


@query(f"""
WITH RECURSIVE {_TITLE_VECTORS}, {_profiles_sql('coalesce(s, 0)')},
{_merged_sql('FROM p', '<= 0.25')}, {_LISTED}
""")
def cluster_profile_close(spark, folder):
    """Complete linkage on rows of the similarity matrix, at a cut that SQL can follow."""
    return _listed(spark, folder, cut=0.25, inclusive=True, space="profile")


_WARD_K = 12
_WARD = f"""
p AS MATERIALIZED (
  SELECT x.id AS a, y.id AS b, 2 - 2 * coalesce(s, 0) AS q
  FROM reps x JOIN reps y ON x.id < y.id LEFT JOIN (
    SELECT u.id AS a, w.id AS b, sum(u.weight * w.weight) AS s
    FROM weights u JOIN weights w USING (term) WHERE u.id < w.id GROUP BY ALL) t
  ON t.a = x.id AND t.b = y.id),
state(step, id, cluster, n, inner_q, distance, gone, kept) AS (
  SELECT 0, id, id, copies::DOUBLE, 0::DOUBLE, NULL::DOUBLE, NULL::BIGINT, NULL::BIGINT FROM reps
  UNION ALL
  SELECT step + 1, s.id, CASE WHEN s.cluster IN (m.a, m.b) THEN m.a ELSE s.cluster END,
         CASE WHEN s.cluster IN (m.a, m.b) THEN m.n ELSE s.n END,
         CASE WHEN s.cluster IN (m.a, m.b) THEN m.inner_q ELSE s.inner_q END, m.d, m.b, m.a
  FROM state s, (
    SELECT a, b, n, inner_q, sqrt(greatest(round(apart, 10), 0)) AS d FROM (
      SELECT a, b, na + nb AS n, qa + qb + cross_q AS inner_q,
             2 * na * nb / (na + nb) * (cross_q / (na * nb) - qa / (na * na) - qb / (nb * nb)) AS apart
      FROM (
        SELECT least(u.cluster, w.cluster) AS a, greatest(u.cluster, w.cluster) AS b,
               any_value(CASE WHEN u.cluster < w.cluster THEN u.n ELSE w.n END) AS na,
               any_value(CASE WHEN u.cluster < w.cluster THEN w.n ELSE u.n END) AS nb,
               any_value(CASE WHEN u.cluster < w.cluster THEN u.inner_q ELSE w.inner_q END) AS qa,
               any_value(CASE WHEN u.cluster < w.cluster THEN w.inner_q ELSE u.inner_q END) AS qb,
               sum(q * x.copies * y.copies) AS cross_q
        FROM p JOIN state u ON u.id = p.a JOIN state w ON w.id = p.b
        JOIN reps x ON x.id = p.a JOIN reps y ON y.id = p.b
        WHERE u.cluster <> w.cluster GROUP BY 1, 2))
    ORDER BY round(apart, 10), md5(concat_ws('-', a::VARCHAR, b::VARCHAR)), a, b LIMIT 1) m
  WHERE step < (SELECT count(*) FROM reps) - {_WARD_K}),
merged AS (SELECT id, cluster FROM state WHERE step = (SELECT max(step) FROM state))"""


@query(f"""
WITH RECURSIVE {_TITLE_VECTORS}, {_WARD}, {_LISTED}
""")
def cluster_ward(spark, folder):
    """Ward's linkage cut where a fixed number of clusters is left."""
    return _listed(spark, folder, method="ward", k=_WARD_K)


@query()  # hundreds of merges over nearly all pairs of documents: too slow in SQL
def cluster_documents_loose(spark, folder):
    """Complete linkage of documents at a loose cut, its pairs found band by band."""
    rows = table(spark, folder, "documents")
    found = cluster_titles(rows, "doc_id", "text", TitleTerms(ngrams=(1, 1)),
                           DOCUMENT_WEIGHTING, cut=0.88, bands=(0.3, 0.5, 0.7, 0.85))
    return found.records()


@query(f"""
WITH RECURSIVE {_TITLE_VECTORS}, {_merged_sql(_pairs_sql(0.35), '<= 0.65')},
steps AS (SELECT DISTINCT step, distance, kept, gone FROM state WHERE step > 0),
sizes AS (SELECT step, cluster, sum(copies) AS size FROM state JOIN reps USING (id) GROUP BY ALL)
SELECT row_number() OVER (ORDER BY distance, kept, gone) AS step, kept AS "left", gone AS "right",
       round(distance, 6) AS distance, size::BIGINT AS size
FROM steps JOIN sizes ON steps.step = sizes.step AND sizes.cluster = steps.kept
""")
def merge_tree(spark, folder):
    found = cluster_titles(products(spark, folder), "product_id", "title", cut=0.65,
                           inclusive=True)
    return linkage.merge_tree(found.merges).select(
        "step", "left", "right", F.round("distance", 6).alias("distance"), "size"
    )


@query(f"""
WITH RECURSIVE {DOCUMENT_TERMS}, pairs AS MATERIALIZED ({_pairs_sql(0.7)}),
reps AS (SELECT a AS id FROM pairs UNION SELECT b FROM pairs),
{_merged_sql('FROM pairs', '< 0.3')}
SELECT doc_id AS id, coalesce(cluster, texts.id) AS cluster FROM documents
JOIN texts ON {_tidy_sql('text')} IS NOT DISTINCT FROM title LEFT JOIN merged USING (id)
""")
def cluster_documents(spark, folder):
    rows = table(spark, folder, "documents")
    found = cluster_titles(rows, "doc_id", "text", TitleTerms(ngrams=(1, 1)),
                           DOCUMENT_WEIGHTING, cut=0.3)
    return found.records()


@query(f"""
WITH RECURSIVE {DOCUMENT_TERMS}, pairs AS ({_pairs_sql(0.7)}),
edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach(id, other) AS (
  SELECT id, id FROM texts
  UNION
  SELECT reach.id, edges.b FROM reach JOIN edges ON reach.other = edges.a),
labels AS (SELECT id, min(other) AS cluster FROM reach GROUP BY id)
SELECT doc_id AS id, cluster FROM documents
JOIN texts ON {_tidy_sql('text')} IS NOT DISTINCT FROM title JOIN labels USING (id)
""")
def cluster_single(spark, folder):
    rows = table(spark, folder, "documents")
    found = cluster_titles(rows, "doc_id", "text", TitleTerms(ngrams=(1, 1)),
                           DOCUMENT_WEIGHTING, cut=0.3, method="single", inclusive=True)
    return found.records()


def _centred(spark, folder, method, **how):
    """(id, cluster) of every product; null for a title without a term to cluster by."""
    rows = products(spark, folder)
    texts = stage(distinct_titles(rows, "product_id", "title", TitleTerms()), "titles")
    grams = text.ngrams(text.word_tokens(F.col("title")), (1, 3))
    found = method(
        stage(centroids.ml_vectors(texts, grams, v.LABELLED_WEIGHTING), "ml-vectors"), **how
    )
    members = text_of_records(rows, "product_id", "title", TitleTerms(), texts)
    return members.join(found.select("id", "cluster"), "id", "left").select(
        F.col("record").alias("id"), "cluster"
    )


@query()
def kmeans(spark, folder):
    return _centred(spark, folder, centroids.kmeans, k=15)


@query()
def kmeans_cosine(spark, folder):
    return _centred(spark, folder, centroids.kmeans, k=11, distance="cosine")


@query()
def bisecting_kmeans(spark, folder):
    return _centred(spark, folder, centroids.bisecting_kmeans, k=12)


_MATCHED = f"""
WITH RECURSIVE {PRODUCTS},
pooled AS (
  SELECT CASE WHEN product_id % 2 = 1 THEN 'left' ELSE 'right' END AS side, product_id, brand,
         regexp_replace(name, '([0-9])([A-Za-z])', '\\1 \\2', 'g') AS title FROM products),
texts AS (
  SELECT title, brand, min(product_id * 2 + CASE side WHEN 'left' THEN 0 ELSE 1 END) AS id,
         count(*) AS copies FROM pooled GROUP BY ALL),
n AS (SELECT count(*) AS n FROM products),
split AS (SELECT id, copies, list_filter(string_split(lower(title), ' '),
            lambda w: w NOT IN ('sale', 'model', 'freeship')) AS t FROM texts),
counts AS (
  SELECT 'title' AS feature, id, copies, term, count(*) AS tf FROM (
    SELECT id, copies, t[i] AS term FROM split, range(1, len(t) + 1) r(i)
    UNION ALL
    SELECT id, copies, t[i] || ' ' || t[i + 1] FROM split, range(1, len(t)) r(i)
    UNION ALL
    SELECT id, copies, t[i] || ' ' || t[i + 1] || ' ' || t[i + 2]
    FROM split, range(1, len(t) - 1) r(i)) GROUP BY ALL
  UNION ALL
  SELECT 'brand', id, copies, lower(brand), 1 FROM texts WHERE brand IS NOT NULL),
kept AS (
  SELECT feature, term, ln((1 + n) / (1 + df)) + 1 AS idf
  FROM (SELECT feature, term, sum(copies) AS df FROM counts GROUP BY ALL), n
  WHERE df >= 0.01 * n AND df <= 0.7 * n),
marks AS (
  SELECT id, copies, string_agg(feature || '|' || term || '=' || tf, ',' ORDER BY feature, term) AS mark
  FROM counts JOIN kept USING (feature, term) GROUP BY id, copies),
reps AS (SELECT mark, min(id) AS id, sum(copies)::BIGINT AS copies FROM marks GROUP BY mark),
raw AS (SELECT feature, reps.id, term, tf * idf AS w FROM reps JOIN counts USING (id)
        JOIN kept USING (feature, term)),
weights AS (SELECT feature, id, term, w / sqrt(sum(w * w) OVER (PARTITION BY feature, id))
            AS weight FROM raw),
{_merged_sql("""SELECT a, b, sim FROM (
  SELECT a.id AS a, b.id AS b, sum(0.5 * a.weight * b.weight) AS sim
  FROM weights a JOIN weights b USING (feature, term) WHERE a.id < b.id GROUP BY a.id, b.id)
  WHERE sim >= 0.58 - 1e-12""", '< 0.42')},
records AS (
  SELECT side, product_id AS id, coalesce(merged.cluster, texts.id) AS cluster_id
  FROM pooled JOIN texts ON pooled.title IS NOT DISTINCT FROM texts.title
                        AND pooled.brand IS NOT DISTINCT FROM texts.brand
  LEFT JOIN marks ON marks.id = texts.id LEFT JOIN reps USING (mark)
  LEFT JOIN merged ON merged.id = reps.id)"""


@query(f"{_MATCHED} SELECT side, id, cluster_id FROM records")
def match_catalogues(spark, folder):
    left, right = catalogues(spark, folder)
    return Matcher().match(left, right, "product_id", "product_id").records


@query(f"""{_MATCHED}
SELECT cluster_id, count_if(side = 'left')::BIGINT AS n_left, count_if(side = 'right')::BIGINT AS n_right,
       (n_left * n_right)::BIGINT AS n_pairs
FROM records GROUP BY cluster_id
""")
def match_counts(spark, folder):
    left, right = catalogues(spark, folder)
    found = Matcher().match(left, right, "product_id", "product_id").clusters
    return found.withColumn("n_pairs", F.col("n_left") * F.col("n_right"))


@query(f"""{_MATCHED}
SELECT id AS product_id, name, brand, records.cluster_id, side
FROM records JOIN products ON product_id = id
""")
def match_write_back(spark, folder):
    left, right = catalogues(spark, folder)
    records = Matcher().match(left, right, "product_id", "product_id").records
    updated = [
        keyed_update(
            target.select("product_id", "name", "brand", "cluster_id"),
            records.filter(F.col("side") == side).select(
                F.col("id").alias("product_id"), F.col("cluster_id").cast("long")
            ),
            "product_id",
        ).withColumn("side", F.lit(side))
        for side, target in (("left", left), ("right", right))
    ]
    return updated[0].unionByName(updated[1])


@query("""
SELECT p_partkey AS product_id, p_name AS name, coalesce(dearest, p_retailprice) AS price, orders
FROM part LEFT JOIN (
  SELECT l_partkey, max(l_extendedprice) AS dearest, count(*) AS orders
  FROM lineitem GROUP BY l_partkey) ON l_partkey = p_partkey
""")
def keyed_update_prices(spark, folder):
    sold = table(spark, folder, "lineitem").groupBy(
        F.col("l_partkey").alias("product_id")
    ).agg(F.max("l_extendedprice").alias("price"), F.count(F.lit(1)).alias("orders"))
    target = products(spark, folder).select("product_id", "name", "price")
    return keyed_update(target, sold, "product_id")
