"""TF-IDF and count vectors in long form, and what is derived from them.

Input is one row per distinct text: ``id``, ``copies`` (how many records share the text) and
an array of terms. Document frequencies are weighted by ``copies``, so the result is that of
the full table while every shuffle carries distinct texts only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import counted_stage, release, stage


@dataclass(frozen=True)
class Weighting:
    """Vocabulary bounds and weights. A float bound is a share of records, an int a count."""

    min_df: float | int = 1
    max_df: float | int = 1.0
    max_features: int | None = None
    idf: bool = True
    norm: bool = True


# The three settings in use.
TITLE_WEIGHTING = Weighting(min_df=0.03, max_df=0.7, max_features=20000)
LABELLED_WEIGHTING = Weighting(min_df=0.05, max_df=0.6)
CATALOGUE_WEIGHTING = Weighting(min_df=0.01, max_df=0.7)


def record_count(texts: DataFrame) -> Column:
    """Number of records, including those without any term, as a scalar subquery."""
    return texts.agg(F.coalesce(F.sum("copies"), F.lit(0))).scalar()


def term_counts(texts: DataFrame, terms: Column) -> DataFrame:
    """(id, term, copies, tf): one row per distinct term of a text.

    A text's terms are counted in its row, sorted, so no row per term is shuffled. Where ids
    repeat, rows of one id count as one text.
    """
    size = F.size("sorted")
    numbers = F.when(size > 0, F.sequence(F.lit(1), size)).otherwise(F.array().cast("array<int>"))
    first = F.filter(numbers, lambda i: (i == 1) | ~F.get("sorted", i - 1).eqNullSafe(
        F.get("sorted", i - 2)))
    counted = F.transform("first", lambda i, nth: F.struct(
        F.get("sorted", i - 1).alias("term"),
        (F.coalesce(F.get("first", nth + 1), size + 1) - i).cast("long").alias("tf")))
    counts = (
        texts.select("id", "copies", F.array_sort(terms).alias("sorted"))
        .withColumn("first", first).select("id", "copies", F.inline(counted))
    )
    if not texts.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        counts = counts.groupBy("id", "term").agg(
            F.first("copies").alias("copies"), F.sum("tf").alias("tf"))
    return counts.select("id", "term", "copies", "tf")


def _kept_counts(
    texts: DataFrame, terms: Column, weighting: Weighting,
) -> tuple[DataFrame, DataFrame]:
    """Term counts, staged, and the terms kept. The texts are made once, not once for each use."""
    if not texts.__dict__.get("staged_at"):
        texts = stage(texts, "texts")
    counts = stage(term_counts(texts, terms), "term-counts")
    return counts, kept_terms(vocabulary(counts), record_count(texts), weighting)


def vocabulary(counts: DataFrame) -> DataFrame:
    """(term, df, corpus_tf) over all records."""
    return counts.groupBy("term").agg(
        F.sum("copies").alias("df"),
        F.sum(F.col("copies") * F.col("tf")).alias("corpus_tf"),
    )


def kept_terms(terms: DataFrame, n: Column, weighting: Weighting) -> DataFrame:
    """Apply the frequency bounds, then the size bound, and add the idf."""
    low, high = weighting.min_df, weighting.max_df
    kept = terms.withColumn("_n", n).filter(
        (F.col("df") >= (F.lit(low) if isinstance(low, int) else low * F.col("_n")))
        & (F.col("df") <= (F.lit(high) if isinstance(high, int) else high * F.col("_n")))
    )
    if weighting.max_features is not None:
        kept = kept.orderBy(F.desc("corpus_tf"), "term").limit(weighting.max_features)
    idf = F.log((1 + F.col("_n")) / (1 + F.col("df"))) + 1 if weighting.idf else F.lit(1.0)
    return kept.withColumn("idf", idf).drop("_n")


def weigh(texts: DataFrame, terms: Column, weighting: Weighting) -> DataFrame:
    """Long form (id, term, df, weight) with each id's weights scaled to length 1."""
    counts, kept = _kept_counts(texts, terms, weighting)
    weights = counts.join(kept, "term").select(
        "id", "term", "df", (F.col("tf") * F.col("idf")).alias("weight")
    )
    if not weighting.norm:
        return weights
    # A window rather than a join: one shuffle by id, and a text has few terms.
    length = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy("id")))
    return weights.withColumn("weight", F.col("weight") / length)


def vectors(
    texts: DataFrame, terms: Column, weighting: Weighting, name: str = "vector",
) -> tuple[DataFrame, DataFrame]:
    """Unit vectors as one array per id, and the vocabulary they index; both are staged.

    The vocabulary is written once with a number per term that rises with document
    frequency; a vector is an array of (number, weight, tail) in that order, rarest first,
    where ``tail`` is the length of the vector from that entry on. The similarity join prunes
    by it. Ids without a kept term have no row.
    """
    counts, kept = _kept_counts(texts, terms, weighting)
    numbered = stage(
        kept.orderBy("df", "term").withColumn("number", F.monotonically_increasing_id()),
        "vocabulary",
    )
    raw = counts.join(numbered, "term").select(
        "id", "number", (F.col("tf") * F.col("idf")).alias("raw")
    )
    # Summed in term order, so equal texts get bit-equal vectors.
    whole = Window.partitionBy("id").orderBy("number")
    square = F.sum(F.col("raw") * F.col("raw"))
    total = square.over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    before = F.coalesce(square.over(whole.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weight = F.col("raw") / F.sqrt(total) if weighting.norm else F.col("raw")
    tail = F.sqrt(F.greatest(total - before, F.lit(0.0)) / total)
    gathered = raw.select(
        "id", F.struct("number", weight.alias("weight"), tail.alias("tail")).alias("entry")
    ).groupBy("id").agg(F.sort_array(F.collect_list("entry")).alias(name))
    gathered = stage(gathered, "vectors")
    release(counts)
    return gathered, numbered


def _hash(names: list[str]) -> Column:
    return F.xxhash64(*names)


def distinct_vectors(
    sparse: DataFrame, sizes: DataFrame, names: list[str],
) -> tuple[DataFrame, DataFrame]:
    """(id -> vector id, one row per distinct vector with its record count).

    Texts that differ only in terms outside the vocabulary have the same vector, and all of
    them stand at distance 0 from each other. Pair work is done once per distinct vector,
    which goes by the least id that has it.

    Vectors meet by hash, and only those that share one are compared, each with that of the least
    id. Those that differ from it all the same are grouped whole.
    """
    rows = sparse.select("id", _hash(names).alias("hash"), *names)
    hashed = stage(rows.select("id", "hash").join(sizes.select("id", "copies"), "id"), "vector-hashes")
    if not sparse.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
        rows = rows.dropDuplicates(["id", *names])
    firsts = hashed.groupBy("hash").agg(F.min("id").alias("vector_id"), F.count(F.lit(1)).alias("n"))
    met = hashed.join(firsts, "hash").select("id", "hash", "copies", "vector_id", "n")
    first = rows.select(F.col("id").alias("vector_id"), "hash",
                        *[F.col(n).alias(f"first_{n}") for n in names])
    # Not as an equation of two sides, or whole vectors would be keys of the join.
    same = F.lit(True)
    for n in names:
        same = same & (F.size(F.array_distinct(F.array(n, f"first_{n}"))) == 1)
    compared, apart = counted_stage(
        met.filter("n > 1").join(rows, ["id", "hash"]).join(first, ["vector_id", "hash"]).select(
            "id", "hash", "copies", "vector_id", same.alias("same")), "vectors-compared", ~F.col("same"))
    named = met.filter("n = 1").drop("n").unionByName(compared.filter("same").drop("same"))
    if apart:
        rest = compared.filter("NOT same").select("id", "hash", "copies").join(rows, ["id", "hash"])
        whole = rest.groupBy(*names).agg(F.min("id").alias("vector_id"))
        whole = stage(whole.select("vector_id", *[F.col(n).alias(f"first_{n}") for n in names]),
                      "vectors-apart")
        on = F.lit(True)
        for n in names:
            on = on & F.col(n).eqNullSafe(F.col(f"first_{n}"))
        named = named.unionByName(rest.join(whole, on).select("id", "hash", "copies", "vector_id"))
    named = stage(named, "vector-ids")
    for table in (hashed, compared):
        release(table)
    counts = named.groupBy(F.col("vector_id").alias("id"), "hash").agg(F.sum("copies").alias("copies"))
    groups = stage(rows.join(counts, ["id", "hash"]).select(*names, "id", "copies"), "distinct-vectors")
    return named.select("id", "vector_id"), groups


def wide_table(weights: DataFrame, limit: int) -> DataFrame:
    """Documents × terms as columns. Meant for reading; refuses more terms than the caller allows."""
    terms = [
        row.term for row in weights.select("term").distinct().orderBy("term")
        .limit(limit + 1).collect()
    ]
    if len(terms) > limit:
        raise ValueError(f"more than {limit} terms: tighten the vocabulary first")
    return weights.groupBy("id").pivot("term", terms).agg(F.sum("weight")).na.fill(0.0)
