"""Benchmark decontamination: size-partitioned MinHash containment search.

Items are short, documents long, so an item is a hit if at least ``threshold``
of its distinct five-word shingles occur in the document (containment, not
Jaccard).  Search: items are partitioned by size (number of distinct shingles,
classes by powers of two); an item's sketch is its bottom-k MinHash, the k
smallest of its shingle hashes, with k = (largest shortfall allowed in its size class) + 1.  A
document that holds ``threshold`` of the item cannot miss all k, so a document
with none of an item's minima is no candidate and no true pair is lost.
Verification: for candidate pairs the exact number of the item's distinct
shingles found in the document, compared as text, not by hash.

Items with equal words are one class, searched once and expanded at the end.
Words are runs of letters and digits, lower case.  An item of fewer than five
words is one shingle of all its words.

Defined results: null or wordless items and documents match nothing; repeated
documents rows give one pair; of a document id that occurs with several texts the
best text makes the pair, rows without an id each make their own; rows are dropped by
their own text; texts of any length are searched whole; empty tables give empty
results; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

SHINGLE = 5
THRESHOLD = 0.8


def normal_words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingle_texts(words: Column, n: int) -> Column:
    """All runs of ``n`` words as text; none if there are fewer words."""
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - n, F.lit(0)))
    runs = F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(n)]))
    return F.when(F.size(words) >= n, runs).otherwise(F.array().cast("array<string>"))


def shingle_hashes(words: Column, n: int) -> Column:
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - n, F.lit(0)))
    runs = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]))
    return F.when(F.size(words) >= n, runs).otherwise(F.array().cast("array<bigint>"))


def item_classes(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(classes: ``class_id, words, n``; members: ``class_id, item_id``)."""
    w = items.select(F.col(id_col).alias("item_id"), normal_words(text_of(text_col)).alias("words")).where(
        F.size("words") > 0).withColumn("joined", F.array_join("words", " "))
    classes = w.groupBy("joined").agg(F.min("item_id").alias("class_id"), F.first("words").alias("words"))
    classes = classes.select("class_id", "joined", "words", F.least(F.size("words"), F.lit(SHINGLE)).alias("n"))
    members = w.join(classes.select("joined", "class_id"), "joined").select("class_id", "item_id").distinct()
    return classes.select("class_id", "words", "n"), members


def item_shingles(classes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``class_id, shingle, hash, size, sketched``: one row per distinct
    shingle; ``sketched`` marks the size class's bottom-k minima."""
    by_n = F.when(F.col("n") == SHINGLE, shingle_texts(F.col("words"), SHINGLE))
    hash_n = F.when(F.col("n") == SHINGLE, shingle_hashes(F.col("words"), SHINGLE))
    for n in range(1, SHINGLE):
        by_n = by_n.when(F.col("n") == n, shingle_texts(F.col("words"), n))
        hash_n = hash_n.when(F.col("n") == n, shingle_hashes(F.col("words"), n))
    rows = classes.select("class_id", "n", by_n.alias("texts"), hash_n.alias("hashes")).select(
        "class_id", "n", F.array_sort(F.array_distinct(F.arrays_zip("hashes", "texts"))).alias("pairs"))
    size = F.size("pairs")
    # Size partition: sizes in (2^(c-1), 2^c] share one k, that of the largest.
    upper = F.pow(F.lit(2.0), F.ceil(F.log2(size.cast("double"))))
    k = (F.floor(upper * (1 - threshold) + 1e-9) + 1).cast("int")
    return rows.select("class_id", "n", size.alias("size"), F.least(k, size).alias("k"),
                       F.posexplode("pairs").alias("at", "p")).select(
        "class_id", "n", "size", F.col("p.hashes").alias("hash"), F.col("p.texts").alias("shingle"),
        (F.col("at") < F.col("k")).alias("sketched"))


def contaminated_texts(docs: DataFrame, classes: DataFrame, threshold: float = THRESHOLD,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, i_class, size, found`` of every text and class of
    items with containment of at least ``threshold``."""
    index = item_shingles(classes, threshold)
    # Shingle lengths that occur among the items: at most five values.
    lengths = sorted(r["n"] for r in index.select("n").distinct().collect())
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))

    worded = texts.select("doc_id", F.xxhash64("text").alias("text_hash"), normal_words(F.col("text")).alias("words"))
    hashes = F.concat(F.array().cast("array<bigint>"), *[shingle_hashes(F.col("words"), n) for n in lengths])
    minima = index.where("sketched").select(F.col("hash").alias("m_hash"), "class_id")
    # Any shared minimum makes the pair a candidate; one row per pair.
    candidates = (worded.select("doc_id", "text_hash", F.explode(hashes).alias("hash"))
                  .join(minima, F.col("hash") == F.col("m_hash"))
                  .select(F.col("doc_id").alias("k_id"), F.col("text_hash").alias("k_text"), "class_id").distinct())

    wanted = candidates.groupBy("k_id", "k_text").agg(F.collect_set("class_id").alias("classes"))
    held = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("k_id"))
                      & (F.xxhash64("text") == F.col("k_text"))).select(
        "doc_id", F.col("k_text").alias("text_hash"), "classes", normal_words(F.col("text")).alias("words"))
    runs = F.concat(F.array().cast("array<string>"), *[shingle_texts(F.col("words"), n) for n in lengths])
    return (held.select("doc_id", "text_hash", "classes", F.explode(F.array_distinct(runs)).alias("run"))
            .join(index.select(F.col("class_id").alias("i_class"), "shingle", "size"),
                  (F.col("run") == F.col("shingle")) & F.array_contains("classes", F.col("i_class")))
            .groupBy("doc_id", "text_hash", "i_class", "size")
            .agg(F.count_distinct("run").alias("found"))
            .where(F.col("found") >= F.col("size") * threshold - 1e-9))


def contaminated_pairs(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, item_shingles, found_shingles, containment`` of every
    pair with containment of at least ``threshold``."""
    classes, members = item_classes(items)
    found = (contaminated_texts(docs, classes, threshold, id_col, text_col)
             .groupBy("doc_id", F.when(F.col("doc_id").isNull(), F.col("text_hash")).alias("own"), "i_class", "size")
             .agg(F.max("found").alias("found")))
    return (found.join(members, F.col("i_class") == F.col("class_id"))
            .select("doc_id", "item_id", F.col("size").cast("long").alias("item_shingles"),
                    F.col("found").cast("long").alias("found_shingles"),
                    (F.col("found") / F.col("size")).alias("containment")))


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all columns."""
    classes, _ = item_classes(items)
    bad = contaminated_texts(docs, classes, threshold).select(
        F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_text")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_bad_id"])
                     & (F.xxhash64(text_of()) == bad["_bad_text"]), "left_anti")
