"""The registered queries of this package and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ctw,
    decontaminate,
    html_text,
    jaccard,
    kdtree,
    language,
    pieces,
    prefix_trie,
    simhash,
    token_files,
    toxicity,
    urls,
    whitening,
)
from .batches import remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# The rules of the URL query.
URL_RULES = [
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
    ("block", "net/es/"), ("block", "net/fr/"),
]


@query
def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on every page's URL."""
    judged = urls.judge(table(spark, folder, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "margin")


SQL["op2_top_k"] = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(generate_series(1, len(q.v)), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op2_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The five best others for every vector whose id is divisible by 50."""
    found = kdtree.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)
    return found.withColumnRenamed("id", "vec_id")


@query
def op3_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, folder, "pages")
    return pages.select("page_id", "url", html_text.extract("html").alias("text")).withColumn(
        "n_chars", F.length("text").cast("long"))


@query
def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Piece ids with merge-dropout of every document, and whether they decode to its text."""
    model = tokenizer_file("piece_bpe_32k.model")
    coded = pieces.encode(table(spark, folder, "documents"), model, lossless_col="lossless")
    return coded.select(
        "doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids", "lossless")


@query
def op5_context_tree(spark: SparkSession, folder: str) -> DataFrame:
    """The log10 probability of every document, learnt from four fifths of them."""
    docs = table(spark, folder, "documents").withColumn("held_out", remainder("doc_id", 5) == 1)
    rows = ctw.score(docs)
    return rows.withColumnRenamed("id", "doc_id").withColumn(
        "bits_per_byte", -F.col("score") * F.log2(F.lit(10.0)) / (F.col("n_bytes") + 1))


@query
def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learnt from two thirds of them."""
    docs = table(spark, folder, "documents").withColumn("held_out", remainder("doc_id", 3) == 1)
    model = language.fit(docs.filter(~F.col("held_out")))
    found = docs.select("doc_id", "held_out", language.predicted(spark, model, "text").alias("p"))
    return found.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"),
                        F.col("p.score").alias("score"), F.col("p.quotient").alias("quotient"))


@query
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of every document, learnt from the labels of two thirds of them."""
    docs = table(spark, folder, "documents").withColumn("held_out", remainder("doc_id", 3) == 1)
    model = toxicity.fit(docs.filter(~F.col("held_out")), table(spark, folder, "labels"))
    found = docs.select("doc_id", "held_out", toxicity.scored(spark, model, "text").alias("s"))
    return found.select(
        "doc_id", "held_out", F.col("s.score").alias("score"),
        (F.col("s.score") >= toxicity.REJECT).cast("int").alias("predicted"),
        F.col("s.worst").alias("worst"))


LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SQL["op8_decontamination"] = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{LETTERS}', '{LETTERS.lower()}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), '{LETTERS}', '{LETTERS.lower()}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
starts AS (
  SELECT item_id, w, least(len(w), 10) AS k, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i
  FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS win FROM starts),
places AS (
  SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i
  FROM words, (SELECT DISTINCT k FROM windows)),
hits AS (
  SELECT doc_id, i, k, item_id
  FROM (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS win FROM places)
  JOIN windows USING (k, win)),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
    SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (
    SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


@query
def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontaminate.matches(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


@query
def op9_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids, as read back from the files they were written to."""
    rows = token_files.round_trip(
        table(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.json"), added=True)
    return rows.withColumnRenamed("id", "doc_id")


@query
def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, folder, "documents"))
    return rows.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# The nested reductions are crc32 of a conversation's decimal number, bit by bit.
SQL["op11_prefix_trie"] = """
WITH own AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, role, text) AS l
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
marked AS (
  SELECT *, xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''),
                                                     lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce(
      list_concat([xor(a, b)], [1::BIGINT, 2, 3, 4, 5, 6, 7, 8]),
      lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 6 AS h FROM own),
rebuilt AS (
  SELECT m.conv_id, list_concat(coalesce(f.l, [])[1:m.h], m.l[m.h + 1:]) AS l
  FROM marked m LEFT JOIN own f ON f.conv_id = m.conv_id - m.conv_id % 100),
passed AS (
  SELECT conv_id, d, l[1:d] AS way, d = len(l) AS ends
  FROM (SELECT conv_id, l, unnest(generate_series(0, len(l))) AS d FROM rebuilt)),
nodes AS (
  SELECT way, d, min(conv_id) AS node, count(*) AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ends
  FROM passed GROUP BY way, d),
named AS (
  SELECT passed.conv_id, passed.d, node FROM passed JOIN nodes USING (way, d)),
parents AS (
  SELECT n.*, p.node AS parent FROM nodes n
  LEFT JOIN named p ON p.conv_id = n.node AND p.d = n.d - 1),
grown AS (
  SELECT x.*, coalesce(c.n, 0) AS n_children,
         CASE WHEN x.d = 0 THEN 0 ELSE (n_convs - 1) * length(way[-1].text) END AS saved
  FROM parents x LEFT JOIN (
    SELECT parent, d - 1 AS d, count(*) AS n FROM parents WHERE d > 0 GROUP BY ALL) c
  ON c.parent = x.node AND c.d = x.d),
totals AS (
  SELECT up.node, up.d, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves,
         sum(saved)::BIGINT AS saved_tokens
  FROM grown g JOIN named up ON up.conv_id = g.node AND up.d <= g.d GROUP BY up.node, up.d)
SELECT node AS conv_id, d AS depth, parent AS parent_conv_id, n_convs, n_children, n_leaves,
       saved_tokens, sha256(ends) AS ends_sha256
FROM grown JOIN totals USING (node, d)
"""


@query
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every beginning that the rebuilt conversations share, with its totals."""
    return prefix_trie.trie(table(spark, folder, "conversations"))


SQL["op12_jaccard"] = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{LETTERS}', '{LETTERS.lower()}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i
        FROM words WHERE len(w) > 0)),
sets AS (SELECT doc_id, count(*) AS n, md5(string_agg(g, '|' ORDER BY g)) AS mark FROM grams GROUP BY doc_id),
reps AS (SELECT mark, min(doc_id) AS id, any_value(n) AS n FROM sets GROUP BY mark),
held AS (SELECT id, n, hash(g) AS g FROM reps JOIN grams ON doc_id = id),
links AS (
  SELECT a.id AS a, b.id AS b FROM held a JOIN held b USING (g)
  WHERE a.id <> b.id GROUP BY a.id, b.id
  HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
reach(id, other) AS (
  SELECT id, id FROM reps UNION SELECT reach.id, b FROM reach JOIN links ON other = a),
least AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)
SELECT doc_id, coalesce(sets.n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM words LEFT JOIN sets USING (doc_id) LEFT JOIN reps USING (mark) LEFT JOIN least USING (id)
"""


@query
def op12_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """The component of every document's five-word shingles, by links of Jaccard 0.8 or more."""
    rows = jaccard.jaccard_components(table(spark, folder, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@query
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector's whitened components."""
    rows = whitening.whiten(table(spark, folder, "embeddings"))
    return rows.withColumnRenamed("id", "vec_id")
