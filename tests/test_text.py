import math

from pyspark.sql import functions as F

from twinshelf.functions import strings, text
from twinshelf.operators.selection import dealt
from twinshelf.operators import vectors as v
from twinshelf.plans import text_queries
from twinshelf.session import stage


def one(spark, column, *values):
    names = [f"c{i}" for i in range(len(values))]
    df = spark.createDataFrame([values], ", ".join(f"{n} string" for n in names))
    return df.select(column(*[F.col(n) for n in names])).first()[0]


def test_normalising_keeps_accents_and_joins_lower_case_units(spark):
    assert one(spark, text.tidy_title, "Điện-thoại 64 gb/5 kg, 3 GB") == "Điện thoại 64gb 5kg  3 GB"
    assert one(spark, text.tidy_title, "1 gbx 2 gb") == "1gbx 2gb"
    assert one(spark, text.split_digits, "8gb 16GB a1") == "8 gb 16 GB a1"
    assert one(spark, lambda c: text.without(c, "🎈🎈"), "🎈🎈new🎈🎈") == "new"


def test_tokens_and_ngrams(spark):
    assert one(spark, text.space_tokens, "A  b ") == ["a", "", "b", ""]
    assert one(spark, text.word_tokens, " Red  Ring ") == ["red", "ring"]
    assert one(spark, text.word_tokens, "   ") == []
    grams = lambda c: text.ngrams(text.word_tokens(c), (1, 3))
    assert one(spark, grams, "a b c") == ["a", "b", "c", "a b", "b c", "a b c"]
    assert one(spark, grams, "a") == ["a"]
    assert one(spark, lambda c: text.drop_words(text.word_tokens(c), ["b"]), "a b a") == ["a", "a"]
    assert one(spark, lambda c: text.lettered(text.word_tokens(c)), "12 a1 é") == ["a1"]


def test_keys(spark):
    assert one(spark, text.url_key, "/a-i.1.2-i.33.44") == "33.44"
    assert one(spark, text.url_key, "/a") is None
    assert one(spark, lambda c: text.shop_and_item(c).item_id, "33.44") == "44"
    assert one(spark, text.html_key, "/x-p12.html?src=1") == "12"
    assert one(spark, lambda a, b: text.lookup_text(a, b), "x", None) == "x"


def test_string_similarity(spark):
    assert one(spark, strings.edit_similarity, "hàng", "hang") == 0.75
    assert one(spark, strings.edit_similarity, "", "") == 1.0
    assert one(spark, strings.edit_similarity, "a", None) == 0.0
    assert one(spark, strings.edit_similarity, "", None) == 0.0
    assert math.isclose(strings.jaro_winkler("martha", "marhta"), 0.9611, abs_tol=1e-4)
    assert math.isclose(strings.jaro_winkler("dixon", "dicksonx"), 0.8133, abs_tol=1e-4)
    assert strings.jaro_winkler("a", "b") == 0.0
    assert one(spark, strings.jaro_winkler_similarity, "a", None) == 0.0


def titles(spark, rows):
    return spark.createDataFrame(rows, "id long, copies long, title string")


def test_tfidf_weighs_copies_and_bounds(spark):
    texts = titles(spark, [(1, 3, "red ring"), (2, 1, "red rod"), (3, 1, "")])
    terms = text.word_tokens(F.col("title"))
    got = {(r.id, r.term): r.weight for r in v.weigh(texts, terms, v.Weighting()).collect()}
    idf = {t: math.log(6 / (1 + df)) + 1 for t, df in (("red", 4), ("ring", 3), ("rod", 1))}
    length = math.hypot(idf["red"], idf["ring"])
    assert math.isclose(got[1, "red"], idf["red"] / length)
    assert set(got) == {(1, "red"), (1, "ring"), (2, "red"), (2, "rod")}
    few = v.weigh(texts, terms, v.Weighting(min_df=2, max_df=0.7))
    assert {r.term for r in few.collect()} == {"ring"}
    top = v.weigh(texts, terms, v.Weighting(max_features=1))
    assert {r.term for r in top.collect()} == {"red"}


def test_vectors_are_unit_and_tails_shrink(spark):
    texts = titles(spark, [(1, 1, "a b c"), (2, 1, "a b"), (3, 5, "a")])
    sparse, _ = v.vectors(texts, text.word_tokens(F.col("title")), v.Weighting())
    for row in sparse.collect():
        assert math.isclose(sum(e.weight ** 2 for e in row.vector), 1.0)
        assert math.isclose(row.vector[0].tail, 1.0)
        assert [e.tail for e in row.vector] == sorted((e.tail for e in row.vector), reverse=True)


def test_rows_are_dealt_to_parts_by_their_number(spark):
    rows = spark.range(0, 120, 1, 1)
    parts = dealt(rows, rows.count(), ["id"], rows=10)
    assert parts.rdd.getNumPartitions() == 12
    assert sorted(r.id for r in parts.collect()) == list(range(120))


def test_titles_are_dealt_before_their_grams_are_counted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(text_queries, "dealt", lambda df, n, by: dealt(df, n, by, rows=1))
    rows = [(1, "red rod", "Brand#1", "SMALL", 3, 1.0), (1, "red rod", "Brand#1", "SMALL", 3, 1.0),
            (None, "new rod", "Brand#2", "SMALL", 4, 1.0)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, "
                                "p_size int, p_retailprice double").write.parquet(
        str(tmp_path / "part.parquet"))
    found = text_queries.ngrams(spark, str(tmp_path))
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().toString()
    counted = {(r.product_id, r.gram): r.n for r in found.collect()}
    assert counted[1, "red rod"] == 2 and counted[None, "new"] == 1


def test_terms_are_counted_without_a_shuffle(spark):
    rows = [(1, 2, ["b", "a", None, "b", None, "c", "b"]), (2, 1, []), (3, 1, None), (4, 1, ["a"])]
    texts = stage(spark.createDataFrame(rows, "id long, copies long, t array<string>"), "texts")
    counts = v.term_counts(texts, F.col("t"))
    assert {tuple(r) for r in counts.collect()} == {
        (1, "a", 2, 1), (1, "b", 2, 3), (1, "c", 2, 1), (1, None, 2, 2), (4, "a", 1, 1)}
    # A row per term went through an exchange and a table of all terms before.
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()


def test_terms_of_repeated_and_missing_ids_are_counted_together(spark):
    rows = [(1, 1, ["a", "b"]), (1, 1, ["b"]), (None, 1, ["a"]), (None, 1, ["a", "c"])]
    texts = spark.createDataFrame(rows, "id long, copies long, t array<string>")
    assert {(r.id, r.term, r.tf) for r in v.term_counts(texts, F.col("t")).collect()} == {
        (1, "a", 1), (1, "b", 2), (None, "a", 2), (None, "c", 1)}


def test_texts_are_made_once_for_weights(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(title):
        made.add(1)
        return title

    titles = spark.createDataFrame([(i, 1, f"w{i} x") for i in range(20)], "id long, copies long, title string")
    texts = titles.select("id", "copies", seen("title").alias("title"))
    v.weigh(texts, text.word_tokens(F.col("title")), v.Weighting()).collect()
    assert made.value == 20
