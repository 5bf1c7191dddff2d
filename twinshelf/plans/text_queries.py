"""Queries: text functions and term vectors, on product titles and on whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import vectors as v
from ..operators.selection import copies, dealt
from ..session import stage
from .registry import PRODUCTS, products, query, table

WORD_RULE = r"[^\p{L}\p{N}_]"


def _tidy_sql(column: str) -> str:
    sql = f"regexp_replace({column}, '{WORD_RULE}', ' ', 'g')"
    for unit in ("kg", "cm", "gb"):
        sql = rf"regexp_replace({sql}, '(\p{{Nd}}) {unit}', '\1{unit}', 'g')"
    return sql


def _words_sql(column: str) -> str:
    return f"list_filter(string_split_regex(lower({column}), '\\s+'), lambda w: w <> '')"


@query(f"SELECT doc_id, {_tidy_sql('text')} AS title FROM documents")
def normalise_titles(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", text.tidy_title(F.col("text")).alias("title")
    )


@query(rf"""
WITH {PRODUCTS}
SELECT product_id, regexp_replace(regexp_replace(title || '/' || cluster_id || ' kg x 3 GB',
       '(\p{{Nd}}) gb', '\1gb', 'g'), '(\p{{Nd}}) kg', '\1kg', 'g') AS title
FROM products
""")
def unit_join(spark, folder):
    long = F.concat("title", F.lit("/"), F.col("cluster_id").cast("string"), F.lit(" kg x 3 GB"))
    return products(spark, folder).select(
        "product_id", text.join_unit(text.join_unit(long, "gb"), "kg").alias("title")
    )


@query(rf"""
WITH {PRODUCTS}
SELECT product_id, regexp_replace(replace(title, ' ', ''), '([0-9])([A-Za-z])', '\1 \2', 'g')
       AS title
FROM products
""")
def digit_split(spark, folder):
    return products(spark, folder).select(
        "product_id",
        text.split_digits(F.replace("title", F.lit(" "), F.lit(""))).alias("title"),
    )


@query(f"""
WITH {PRODUCTS}, split AS (
  SELECT product_id, string_split(lower(name || '  ' || brand), ' ') AS tokens FROM products)
SELECT product_id, unnest(range(len(tokens))) AS position, unnest(tokens) AS token FROM split
""")
def space_tokens(spark, folder):
    both = F.concat("name", F.lit("  "), "brand")
    return products(spark, folder).select(
        "product_id", F.posexplode(text.space_tokens(both)).alias("position", "token")
    ).withColumn("position", F.col("position").cast("long"))


@query(f"""
WITH words AS (SELECT doc_id, unnest({_words_sql(_tidy_sql('text'))}) AS word FROM documents)
SELECT word, count(*) AS n, count(DISTINCT doc_id) AS documents FROM words GROUP BY word
""")
def word_tokens(spark, folder):
    words = table(spark, folder, "documents").select(
        "doc_id", F.explode(text.word_tokens(text.tidy_title(F.col("text")))).alias("word")
    )
    per_document = words.groupBy("word", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return per_document.groupBy("word").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("documents")
    )


@query(f"""
WITH {PRODUCTS}
SELECT product_id, lower(brand) AS token FROM products
""")
def whole_tokens(spark, folder):
    return products(spark, folder).select(
        "product_id", F.explode(text.whole_token(F.col("brand"))).alias("token")
    )


_GRAMS = """
  SELECT product_id, t[i] AS gram FROM split, range(1, len(t) + 1) r(i)
  UNION ALL
  SELECT product_id, t[i] || ' ' || t[i + 1] FROM split, range(1, len(t)) r(i)
  UNION ALL
  SELECT product_id, t[i] || ' ' || t[i + 1] || ' ' || t[i + 2] FROM split, range(1, len(t) - 1) r(i)
"""


def _counted_grams(spark, folder, tokens):
    """(product_id, gram, n). Titles are dealt before they are taken apart, since the table of
    what a task counts grows with its titles, and one file of them may be one task's."""
    rows = products(spark, folder)
    titles = dealt(rows.select("product_id", "title"), rows.count(), ["product_id", "title"])
    return (
        titles.select("product_id", tokens.alias("tokens"))
        .select("product_id", F.explode(text.ngrams(F.col("tokens"), (1, 3))).alias("gram"))
        .groupBy("product_id", "gram").agg(F.count(F.lit(1)).alias("n"))
    )


@query(f"""
WITH {PRODUCTS}, split AS (
  SELECT product_id, {_words_sql(_tidy_sql('title'))} AS t FROM products),
grams AS ({_GRAMS})
SELECT product_id, gram, count(*) AS n FROM grams GROUP BY ALL
""")
def ngrams(spark, folder):
    return _counted_grams(spark, folder, text.word_tokens(text.tidy_title(F.col("title"))))


_STOP = "('freeship','hàng','nhập','khẩu','chính','hãng','sale','model','rẻ','red','new','promo')"


@query(f"""
WITH {PRODUCTS}, split AS (
  SELECT product_id, list_filter({_words_sql(_tidy_sql('title'))}, lambda w: w NOT IN {_STOP}) AS t
  FROM products),
grams AS ({_GRAMS})
SELECT product_id, gram, count(*) AS n FROM grams GROUP BY ALL
""")
def stopwords(spark, folder):
    stop = [*text.CATALOGUE_STOP_WORDS, "red", "new", "promo"]
    return _counted_grams(
        spark, folder, text.drop_words(text.word_tokens(text.tidy_title(F.col("title"))), stop))


@query(f"""
WITH words AS (
  SELECT doc_id, list_filter({_words_sql(_tidy_sql('text'))},
                             lambda w: regexp_matches(w, '[a-zA-Z]')) AS kept
  FROM documents)
SELECT doc_id, len(kept)::BIGINT AS n, array_to_string(kept, ' ') AS words FROM words
""")
def lettered_tokens(spark, folder):
    kept = text.lettered(text.word_tokens(text.tidy_title(F.col("text"))))
    return table(spark, folder, "documents").select("doc_id", kept.alias("kept")).select(
        "doc_id", F.size("kept").cast("long").alias("n"),
        F.array_join("kept", " ").alias("words"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_suppkey || '.' || l_partkey AS key,
       l_suppkey::VARCHAR AS shop_id, l_partkey::VARCHAR AS item_id,
       'https://shop.example' || '/' || p_name || '-i.' || l_suppkey || '.' || l_partkey
       AS url_path,
       concat_ws('_', p_name, p_brand, nullif(p_type, 'PROMO'), l_shipmark) AS lookup,
       replace(p_name, 'ed', '') AS shorter
FROM (SELECT *, NULL::VARCHAR AS l_shipmark FROM lineitem) JOIN part ON l_partkey = p_partkey
""")
def keys_and_lookups(spark, folder):
    sold = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"
    ).join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    link = F.concat(
        F.lit("/"), "p_name", F.lit("-i."), F.col("l_suppkey").cast("string"), F.lit("."),
        F.col("l_partkey").cast("string"),
    )
    keyed = sold.withColumn("href", link).withColumn("key", text.url_key(F.col("href")))
    parts = text.shop_and_item(F.col("key"))
    return keyed.select(
        "l_orderkey", "l_linenumber", "key", parts.shop_id.alias("shop_id"),
        parts.item_id.alias("item_id"),
        F.concat(F.lit("https://shop.example"), "href").alias("url_path"),
        text.lookup_text(F.col("p_name"), F.col("p_brand"),
                         F.expr("nullif(p_type, 'PROMO')"), F.lit(None).cast("string"))
        .alias("lookup"),
        text.without(F.col("p_name"), "ed").alias("shorter"),
    )


def _title_texts(spark, folder):
    tidy = text.tidy_title(F.col("title"))
    texts = copies(
        products(spark, folder).select(F.col("product_id").alias("record"), tidy.alias("title")),
        ["title"], "record",
    )
    return texts, text.ngrams(text.word_tokens(F.col("title")), (1, 3))


_TERMS = f"""split AS (
  SELECT product_id, {_words_sql(_tidy_sql('title'))} AS t FROM products),
grams AS ({_GRAMS}),
counts AS (SELECT product_id, gram AS term, count(*) AS tf FROM grams GROUP BY ALL),
vocabulary AS (
  SELECT term, count(*) AS df, sum(tf)::BIGINT AS corpus_tf FROM counts GROUP BY term)"""


@query(f"WITH {PRODUCTS}, {_TERMS} SELECT term, df, corpus_tf FROM vocabulary")
def vocabulary(spark, folder):
    texts, terms = _title_texts(spark, folder)
    return v.vocabulary(v.term_counts(stage(texts, "texts"), terms))


@query(f"""
WITH {PRODUCTS}, {_TERMS}, n AS (SELECT count(*) AS n FROM products),
texts AS (SELECT {_tidy_sql('title')} AS title, min(product_id) AS id FROM products GROUP BY 1),
kept AS (SELECT term, ln((1 + n) / (1 + df)) + 1 AS idf FROM vocabulary, n
         WHERE df >= 0.01 * n AND df <= 0.6 * n ORDER BY corpus_tf DESC, term LIMIT 100),
raw AS (SELECT id, term, tf * idf AS w FROM counts JOIN texts ON id = product_id
        JOIN kept USING (term))
SELECT id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS weight FROM raw
""")
def tfidf(spark, folder):
    texts, terms = _title_texts(spark, folder)
    weighting = v.Weighting(min_df=0.01, max_df=0.6, max_features=100)
    return v.weigh(texts, terms, weighting).select(
        "id", "term", F.round("weight", 6).alias("weight")
    )


@query(f"""
WITH {PRODUCTS}, {_TERMS}, n AS (SELECT count(*) AS n FROM products),
texts AS (SELECT {_tidy_sql('title')} AS title, min(product_id) AS id FROM products GROUP BY 1)
SELECT id, term, tf::DOUBLE AS weight FROM counts JOIN texts ON id = product_id
JOIN vocabulary USING (term), n WHERE df >= 10 AND df <= 0.6 * n
""")
def count_vectors(spark, folder):
    texts, terms = _title_texts(spark, folder)
    weighting = v.Weighting(min_df=10, max_df=0.6, idf=False, norm=False)
    return v.weigh(texts, terms, weighting).select(
        "id", "term", F.col("weight").cast("double").alias("weight")
    )


DOCUMENT_TERMS = f"""texts AS (
  SELECT {_tidy_sql('text')} AS title, min(doc_id) AS id, count(*) AS copies
  FROM documents GROUP BY 1),
words AS (SELECT id, copies, unnest({_words_sql('title')}) AS term FROM texts),
counts AS (SELECT id, term, copies, count(*) AS tf FROM words GROUP BY ALL),
kept AS (
  SELECT term, ln((1 + n) / (1 + df)) + 1 AS idf
  FROM (SELECT term, sum(copies) AS df FROM counts GROUP BY term),
       (SELECT count(*) AS n FROM documents)
  WHERE df >= 2 AND df <= 0.6 * n),
raw AS (SELECT id, term, tf * idf AS w FROM counts JOIN kept USING (term)),
weights AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM raw)"""

DOCUMENT_WEIGHTING = v.Weighting(min_df=2, max_df=0.6)


def document_texts(spark, folder):
    tidy = text.tidy_title(F.col("text"))
    documents = table(spark, folder, "documents")
    texts = copies(
        documents.select(F.col("doc_id").alias("record"), tidy.alias("title")),
        ["title"], "record",
    )
    return texts, text.word_tokens(F.col("title"))


@query(f"WITH {DOCUMENT_TERMS} SELECT id, term, round(weight, 6) AS weight FROM weights")
def tfidf_documents(spark, folder):
    texts, terms = document_texts(spark, folder)
    return v.weigh(texts, terms, DOCUMENT_WEIGHTING).select(
        "id", "term", F.round("weight", 6).alias("weight")
    )


@query(f"""
WITH {PRODUCTS}, texts AS (
  SELECT name AS title, min(product_id) AS id FROM products GROUP BY name),
words AS (SELECT id, unnest({_words_sql('title')}) AS term FROM texts)
SELECT id, {', '.join(f"count(*) FILTER (term = '{t}')::DOUBLE AS {t}" for t in
                      ['anvil', 'blue', 'bolt', 'cold', 'gear', 'gizmo', 'hot', 'large', 'new', 'old',
                       'plate', 'red', 'ring', 'rod', 'small', 'widget'])}
FROM words GROUP BY id
""")
def wide_table(spark, folder):
    texts = copies(
        products(spark, folder).select(F.col("product_id").alias("record"),
                                       F.col("name").alias("title")),
        ["title"], "record",
    )
    weights = v.weigh(texts, text.word_tokens(F.col("title")),
                      v.Weighting(idf=False, norm=False))
    return v.wide_table(weights, limit=1000)
