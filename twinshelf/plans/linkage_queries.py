"""Queries: candidate sets, field comparisons, record linkage and the fuzzy join."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import lookup_text
from ..operators import candidates as c
from ..operators.fuzzy import fuzzy_left_join
from ..operators.linking import Compare, Linkage, listing
from .registry import PRODUCTS, catalogues, products, query

_SIDES = f"""{PRODUCTS},
l AS (SELECT * FROM products WHERE product_id % 2 = 1),
r AS (SELECT * FROM products WHERE product_id % 2 = 0),
ranks AS (SELECT brand, dense_rank() OVER (ORDER BY brand) AS rank
          FROM (SELECT DISTINCT brand FROM products))"""

_ALL = "true"
_BLOCK = "lp.brand = rp.brand"
_NEAR = "abs(lr.rank - rr.rank) <= 1"


def _blocks_sql(rule: str) -> str:
    return f"""
WITH {_SIDES},
lp AS (SELECT brand, rank, count(*) AS n FROM l JOIN ranks USING (brand) GROUP BY ALL),
rp AS (SELECT brand, rank, count(*) AS n FROM r JOIN ranks USING (brand) GROUP BY ALL)
SELECT lp.brand AS left_key, rp.brand AS right_key, lp.n AS n_left, rp.n AS n_right,
       lp.n * rp.n AS n_pairs
FROM lp, rp WHERE {rule}"""


@query(f"""
WITH {_SIDES}
SELECT NULL::VARCHAR AS left_key, NULL::VARCHAR AS right_key, a.n AS n_left, b.n AS n_right,
       a.n * b.n AS n_pairs
FROM (SELECT count(*) AS n FROM l) a, (SELECT count(*) AS n FROM r) b
""")
def pairs_full(spark, folder):
    return c.full_size(*catalogues(spark, folder))


@query(_blocks_sql("lp.brand = rp.brand"))
def pairs_block(spark, folder):
    left, right = catalogues(spark, folder)
    keys = c.block_keys(left, right, "brand", "brand")
    return c.candidate_blocks(keys, left, right, "brand", "brand")


@query(_blocks_sql("abs(lp.rank - rp.rank) <= 1"))
def pairs_sorted_neighbourhood(spark, folder):
    left, right = catalogues(spark, folder)
    keys = c.neighbour_keys(left, right, "brand", "brand")
    return c.candidate_blocks(keys, left, right, "brand", "brand")


@query(f"""
WITH {PRODUCTS},
k AS (SELECT cluster_id, count(*) AS n, dense_rank() OVER (ORDER BY cluster_id) AS rank
      FROM products GROUP BY cluster_id)
SELECT a.cluster_id AS left_key, b.cluster_id AS right_key, a.n AS n_left, b.n AS n_right,
       CASE WHEN a.rank = b.rank THEN a.n * (a.n - 1) // 2 ELSE a.n * b.n END AS n_pairs
FROM k a, k b WHERE b.rank - a.rank BETWEEN 0 AND 1
  AND (a.rank < b.rank OR a.n > 1)
""")
def dedupe_candidates(spark, folder):
    rows = products(spark, folder)
    keys = c.neighbour_keys(rows, rows, "cluster_id", "cluster_id")
    return c.self_candidate_blocks(keys, rows, "cluster_id")


# Category stands in for the town, the name for the name, name and brand for the address.
COMPARES = (
    Compare("category", "category", "same_category"),
    Compare("name", "name", "same_name", "edit", 0.85),
    Compare("address", "address", "same_address", "jaro_winkler", 0.85),
)


def _sides(spark, folder):
    address = F.concat("name", F.lit(" "), "brand")
    return [df.withColumn("address", address) for df in catalogues(spark, folder)]


def linked(spark, folder, pairing: str) -> Linkage:
    left, right = _sides(spark, folder)
    keys = {
        "full": lambda: None,
        "block": lambda: c.block_keys(left, right, "brand", "brand"),
        "neighbours": lambda: c.neighbour_keys(left, right, "brand", "brand"),
    }[pairing]()
    return Linkage(left, right, "product_id", "product_id", COMPARES, keys, "brand", "brand")


def _compared_sql(rule: str) -> str:
    return f"""
WITH {_SIDES},
lp AS (SELECT brand, category, name, name || ' ' || brand AS address, min(product_id) AS id,
              count(*) AS n FROM l GROUP BY ALL),
rp AS (SELECT brand, category, name, name || ' ' || brand AS address, min(product_id) AS id,
              count(*) AS n FROM r GROUP BY ALL),
compared AS (
  SELECT lp.id AS left_id, rp.id AS right_id, lp.n AS n_left, rp.n AS n_right,
         lp.n * rp.n AS n_pairs,
         (lp.category = rp.category)::INT AS same_category,
         (1 - levenshtein(lp.name, rp.name) / greatest(length(lp.name), length(rp.name))
          >= 0.85)::INT AS same_name,
         (jaro_winkler_similarity(lp.address, rp.address) >= 0.85)::INT AS same_address,
         same_category + same_name + same_address AS score,
         concat_ws('_', lp.name, lp.brand, lp.category) AS left_lookup,
         concat_ws('_', rp.name, rp.brand, rp.category) AS right_lookup
  FROM lp JOIN ranks lr ON lr.brand = lp.brand, rp JOIN ranks rr ON rr.brand = rp.brand
  WHERE {rule})"""


_MATCH_COLUMNS = """left_id, right_id, n_left, n_right, n_pairs, same_category, same_name,
       same_address, score"""


def _matches_sql(rule: str) -> str:
    return f"{_compared_sql(rule)} SELECT {_MATCH_COLUMNS} FROM compared WHERE score > 1"


def _histogram_sql(rule: str) -> str:
    return f"""{_compared_sql(rule)}
SELECT score, sum(n_pairs)::BIGINT AS n_pairs FROM compared GROUP BY score"""


@query(_matches_sql(_NEAR))
def potential_matches(spark, folder):
    return linked(spark, folder, "neighbours").matches(at_least=2)


@query(_matches_sql(_BLOCK))
def potential_matches_block(spark, folder):
    return linked(spark, folder, "block").matches(at_least=2)


@query(_matches_sql(_ALL))
def potential_matches_full(spark, folder):
    return linked(spark, folder, "full").matches(at_least=2)


@query(_histogram_sql(_NEAR))
def score_histogram(spark, folder):
    return linked(spark, folder, "neighbours").histogram()


@query(_histogram_sql(_BLOCK))
def score_histogram_block(spark, folder):
    return linked(spark, folder, "block").histogram()


@query(f"""{_compared_sql(_BLOCK)}
SELECT left_id, right_id, score, n_left, n_right, left_lookup, right_lookup
FROM compared WHERE score > 1
""")
def match_listing(spark, folder):
    left, right = catalogues(spark, folder)
    lookup = lookup_text(F.col("name"), F.col("brand"), F.col("category"))
    return listing(
        linked(spark, folder, "block").matches(at_least=2),
        left.select(F.col("product_id").alias("left_id"), lookup.alias("left_lookup")),
        right.select(F.col("product_id").alias("right_id"), lookup.alias("right_lookup")),
    )


@query(f"""{_compared_sql(_BLOCK)}
SELECT l.product_id AS left_record, r.product_id AS right_record, left_id, right_id, score,
       left_lookup, right_lookup
FROM compared JOIN lp x ON x.id = left_id JOIN rp y ON y.id = right_id
JOIN l ON (l.brand, l.category, l.name) = (x.brand, x.category, x.name)
JOIN r ON (r.brand, r.category, r.name) = (y.brand, y.category, y.name)
WHERE score > 1
""")
def match_record_listing(spark, folder):
    """Every matched pair of records with both lookup texts."""
    link = linked(spark, folder, "block")
    lookup = lookup_text(F.col("name"), F.col("brand"), F.col("category"))
    left, right = [
        df.select(F.col("product_id").alias("record"), lookup.alias(f"{side}_lookup"))
        for side, df in zip(("left", "right"), catalogues(spark, folder))
    ]
    return link.record_pairs(link.matches(at_least=2), left, right).select(
        "left_record", "right_record", "left_id", "right_id", "score", "left_lookup", "right_lookup")


DEDUPE = (Compare("title", "title", "title", "edit", 0.85),)


def duplicates(spark, folder) -> Linkage:
    rows = products(spark, folder)
    keys = c.neighbour_keys(rows, rows, "cluster_id", "cluster_id")
    return Linkage(rows, rows, "product_id", "product_id", DEDUPE, keys,
                   "cluster_id", "cluster_id", itself=True)


_DEDUPE_SQL = f"""
WITH {PRODUCTS},
p AS (SELECT cluster_id, title, min(product_id) AS id, count(*) AS n FROM products GROUP BY ALL),
k AS (SELECT cluster_id, dense_rank() OVER (ORDER BY cluster_id) AS rank
      FROM (SELECT DISTINCT cluster_id FROM products)),
ranked AS (SELECT * FROM p JOIN k USING (cluster_id)),
compared AS (
  SELECT a.id AS left_id, b.id AS right_id, a.n AS n_left, b.n AS n_right,
         CASE WHEN a.id = b.id THEN a.n * (a.n - 1) // 2 ELSE a.n * b.n END AS n_pairs,
         (1 - levenshtein(a.title, b.title) / greatest(length(a.title), length(b.title))
          >= 0.85)::INT AS title
  FROM ranked a JOIN ranked b ON abs(a.rank - b.rank) <= 1
  WHERE a.id < b.id OR (a.id = b.id AND a.n > 1))"""


@query(f"""{_DEDUPE_SQL}
SELECT left_id, right_id, n_left, n_right, n_pairs, title, title AS score
FROM compared WHERE title >= 1
""")
def dedupe_matches(spark, folder):
    return duplicates(spark, folder).matches(at_least=1).orderBy(
        "score", "left_id", "right_id"
    )


@query(f"""{_DEDUPE_SQL}
SELECT least(x.product_id, y.product_id) AS left_record,
       greatest(x.product_id, y.product_id) AS right_record, left_id, right_id
FROM (SELECT left_id, right_id FROM compared WHERE title >= 1) c
JOIN p a ON a.id = left_id JOIN p b ON b.id = right_id
JOIN products x ON (x.cluster_id, x.title) = (a.cluster_id, a.title)
JOIN products y ON (y.cluster_id, y.title) = (b.cluster_id, b.title)
WHERE left_id < right_id OR x.product_id < y.product_id
""")
def dedupe_record_pairs(spark, folder):
    """Every pair of records of one table whose titles agree, the lesser first."""
    link = duplicates(spark, folder)
    return link.record_pairs(link.matches(at_least=1)).select(
        F.least("left_record", "right_record").alias("left_record"),
        F.greatest("left_record", "right_record").alias("right_record"), "left_id", "right_id")


@query(f"""{_DEDUPE_SQL}
SELECT title AS score, sum(n_pairs)::BIGINT AS n_pairs FROM compared GROUP BY title
""")
def dedupe_histogram(spark, folder):
    return duplicates(spark, folder).histogram()


def _fuzzy_part(i: int, column: str) -> str:
    tokens = (f"list_distinct(list_filter(string_split_regex(lower(regexp_replace({column}, "
              r"'[^\p{L}\p{N}_]', ' ', 'g')), '\s+'), lambda w: w <> ''))")
    return f"SELECT side, id, n, {i} AS col, unnest({tokens}) AS token FROM texts"


_FUZZY = f"""
WITH {PRODUCTS},
texts AS (
  SELECT CASE WHEN product_id % 2 = 1 THEN 'l' ELSE 'r' END AS side, name, brand, category,
         min(product_id) AS id, count(*) AS n
  FROM products GROUP BY ALL),
tokens AS ({_fuzzy_part(0, 'name')} UNION ALL {_fuzzy_part(1, 'brand')}
           UNION ALL {_fuzzy_part(2, 'category')}),
idf AS (SELECT col, token, ln((1 + (SELECT count(*) FROM products)) / (1 + sum(n))) + 1 AS idf
        FROM tokens GROUP BY col, token),
weighted AS (SELECT side, id, col, token, idf, sum(idf) OVER (PARTITION BY side, id, col) AS mass
             FROM tokens JOIN idf USING (col, token)),
fields AS (
  SELECT a.id AS l, b.id AS r, a.col, sum(a.idf) / greatest(any_value(a.mass), any_value(b.mass))
         AS part
  FROM weighted a JOIN weighted b ON a.col = b.col AND a.token = b.token
  WHERE a.side = 'l' AND b.side = 'r' GROUP BY ALL),
scores AS (SELECT l, r, round(sum(part) / 3, 9) AS score FROM fields GROUP BY l, r),
best AS (SELECT l, r, score FROM scores
         QUALIFY row_number() OVER (PARTITION BY l ORDER BY score DESC, r) = 1),
joined AS (
  SELECT p.product_id AS left_id, round(b.score, 6) AS best_match_score, b.r AS right_id,
         p.name, q.name AS right_name, p.brand, q.brand AS right_brand
  FROM products p
  JOIN texts t ON t.side = 'l' AND t.name = p.name AND t.brand = p.brand
              AND t.category = p.category
  LEFT JOIN best b ON b.l = t.id LEFT JOIN products q ON q.product_id = b.r
  WHERE p.product_id % 2 = 1)"""


def fuzzy_joined(spark, folder):
    left, right = catalogues(spark, folder)
    columns = ["name", "brand", "category"]
    other = right.select(
        F.col("product_id").alias("right_id"), *[F.col(n).alias(f"right_{n}") for n in columns]
    )
    return fuzzy_left_join(
        left.withColumnRenamed("product_id", "left_id").select("left_id", *columns), other,
        columns, [f"right_{n}" for n in columns], "left_id", "right_id",
    ).select(
        "left_id", F.round("best_match_score", 6).alias("best_match_score"), "right_id",
        "name", "right_name", "brand", "right_brand",
    )


@query(f"{_FUZZY} SELECT * FROM joined")
def fuzzy_left(spark, folder):
    return fuzzy_joined(spark, folder)


@query(f"{_FUZZY} SELECT * FROM joined ORDER BY best_match_score DESC, left_id LIMIT 5")
def fuzzy_top(spark, folder):
    return fuzzy_joined(spark, folder).orderBy(
        F.col("best_match_score").desc_nulls_last(), "left_id"
    ).limit(5)
