"""Quality rules: per-document base rules and cross-document line frequency.

Only DataFrame functions: texts are read once, each row leaves a narrow record
(counts, a hash and a word count per line), and the rest works on those records.

Line frequency: lines are normalised (white space collapsed, lower case) and
hashed; per host (``source``) the distinct documents of each line are counted;
a line found in more than ``max_docs`` documents is removed (``clean_good`` gives
the texts without such lines, the verdicts tell who is left); a document whose
remaining words are fewer than ``min_left`` or than ``min_left_share`` of its
words is depleted and rejected.

Copies of one text are left to the deduplication stages: documents with the same
normalised lines from first to last count as one.

Defined results: a null text has no words and fails the base rules; a null
source is a host of its own; rows repeated with the same ``doc_id``, source and
text count once; texts of any length are judged whole; an empty table gives an
empty result; columns other than ``doc_id, text, source`` are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, WORD_PATTERN, let, split_words, text_of, written

# Fixed by the contract.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

MAX_DOCS = 20
MIN_LEFT = 10
MIN_LEFT_SHARE = 0.2


def _window_hashes(words: Column, n: int) -> Column:
    """64-bit hash of every window of ``n`` words."""
    some = F.size(words) >= n
    starts = F.sequence(F.lit(0), F.greatest(F.size(words) - n, F.lit(0)))
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]))
    return F.when(some, hashes).otherwise(F.array().cast("array<bigint>"))


def _covered_words(hashes: Column, n: int) -> Column:
    """Words inside windows whose hash occurs twice or more: sort (hash,
    position), keep positions with an equal neighbour, add up the gaps."""
    keyed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def positions(s):
        hit = F.transform(s, lambda x, j: F.when(
            (F.get(s, j - 1)["h"] == x["h"]) | (F.get(s, j + 1)["h"] == x["h"]), x["i"]))
        return F.sort_array(F.filter(hit, lambda p: p.isNotNull()))

    def total(p):
        step = F.transform(p, lambda v, j: F.least(F.lit(n), F.coalesce(F.get(p, j + 1) - v, F.lit(n))))
        return F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)

    return let(let(keyed, positions), total)


def _has_word(line: Column) -> Column:
    return line.rlike(WORD_PATTERN)


def _normal(line: Column) -> Column:
    return F.lower(F.btrim(F.regexp_replace(line, SPACE_CLASS + "+", " ")))


def document_records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     host_col: str = "source") -> DataFrame:
    """One narrow row per document row: base counts, signature, and
    ``lines: array<struct<hash, words>>`` of the lines that have a word."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), text_of(text_col).alias("text"))
    split = base.select("doc_id", "host", "text", split_words(F.col("text")).alias("words"),
                        F.filter(F.split("text", "\n"), _has_word).alias("raw_lines"))
    symbols = F.octet_length("text") - F.octet_length(F.translate("text", SYMBOLS, ""))
    parts = split.select(
        "doc_id", "host",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        (F.size("raw_lines") - F.size(F.array_distinct("raw_lines"))).cast("long").alias("n_dup_lines"),
        _window_hashes(F.col("words"), WINDOW).alias("hashes"),
        F.xxhash64("text").alias("text_hash"),
        F.transform("raw_lines", _normal).alias("norm"))
    repeated = F.size("hashes") > F.size(F.array_distinct("hashes"))
    return parts.select(
        "doc_id", "host", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.when(repeated, _covered_words(F.col("hashes"), WINDOW)).otherwise(F.lit(0)).cast("long")
        .alias("n_repeat_words"),
        F.md5(F.array_join("norm", "\n").cast("binary")).alias("signature"),
        F.transform("norm", lambda l: F.struct(
            F.xxhash64(l).alias("hash"),
            (F.length(l) - F.length(F.replace(l, F.lit(" "), F.lit(""))) + 1).cast("int").alias("words")))
        .alias("lines"))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (n_repeat_words * 100 > n_words * MAX_REPEAT_PERCENT)


def lines_over_limit(records: DataFrame, max_docs: int = MAX_DOCS) -> DataFrame:
    """``host, hash, doc_id, text_hash, n_words, words, rows``: the lines of each
    document that are over the limit in its host."""
    lines = records.select("doc_id", "host", "text_hash", F.xxhash64("signature").alias("sig"), "n_words",
                           F.explode("lines").alias("line")).select(
        "doc_id", "host", "text_hash", "sig", "n_words", F.col("line.hash").alias("hash"),
        F.col("line.words").alias("words"))
    # Lines that can be over the limit at all: a map-side combined count.
    often = (lines.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("rows"))
             .where(F.col("rows") > max_docs)
             .select(F.col("host").alias("o_host"), F.col("hash").alias("o_hash")))
    hits = lines.join(often, F.col("host").eqNullSafe(F.col("o_host")) & (F.col("hash") == F.col("o_hash")),
                      "left_semi")
    # One row per document and line (a document that repeats a line loses each
    # occurrence; a repeated row of the table has the same text hash).
    per_doc = hits.groupBy("host", "hash", "doc_id", "text_hash", "sig", "n_words", "words").agg(
        F.count(F.lit(1)).alias("rows"))
    over = (per_doc.groupBy("host", "hash", "sig").agg(F.lit(1).alias("one"))
            .groupBy("host", "hash").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") > max_docs)
            .select(F.col("host").alias("b_host"), F.col("hash").alias("b_hash")))
    return per_doc.join(over, F.col("host").eqNullSafe(F.col("b_host")) & (F.col("hash") == F.col("b_hash")),
                        "left_semi")


def depleted_documents(records: DataFrame, over: DataFrame, min_left: int = MIN_LEFT,
                       min_left_share: float = MIN_LEFT_SHARE) -> DataFrame:
    """``doc_id, host, text_hash, left_words`` of the documents that lose too much."""
    lost = over.groupBy("doc_id", "host", "text_hash", "n_words").agg(F.sum(F.col("rows") * F.col("words")).alias("lost"))
    copies = records.groupBy("doc_id", "host", "text_hash").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    repeated = copies.select(F.col("doc_id").alias("c_id"), F.col("host").alias("c_host"),
                             F.col("text_hash").alias("c_hash"), "copies")
    left = (lost.join(repeated, F.col("doc_id").eqNullSafe(F.col("c_id")) & F.col("host").eqNullSafe(F.col("c_host"))
                      & (F.col("text_hash") == F.col("c_hash")), "left")
            .withColumn("left_words", F.col("n_words") - F.col("lost") / F.coalesce("copies", F.lit(1))))
    return left.where((F.col("left_words") < min_left) | (F.col("left_words") < F.col("n_words") * min_left_share)
                      ).select("doc_id", "host", "text_hash", F.col("left_words").cast("long"))


def _judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
            max_docs: int = MAX_DOCS, **left) -> tuple[DataFrame, DataFrame]:
    """(verdicts, lines over the limit)."""
    records = written(document_records(docs, id_col, text_col, host_col), "quality")
    over = lines_over_limit(records, max_docs)
    depleted = depleted_documents(records, over, **left).select(
        F.col("doc_id").alias("d_id"), F.col("host").alias("d_host"), F.col("text_hash").alias("d_hash"),
        F.lit(True).alias("depleted"))
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    verdicts = (records.drop("lines", "signature")
                .join(depleted, F.col("doc_id").eqNullSafe(F.col("d_id")) & F.col("host").eqNullSafe(F.col("d_host"))
                      & (F.col("text_hash") == F.col("d_hash")), "left")
                .select("doc_id", "host", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        failed.alias("base_failed"),
                        (~failed & F.col("depleted").isNull()).alias("kept")))
    return verdicts, over


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                  **limits) -> DataFrame:
    """Per document row: base counts, ``base_failed``, ``kept``, and ``host`` and
    ``text_hash`` (with ``doc_id`` the key of the row)."""
    return _judged(docs, id_col, text_col, host_col, **limits)[0]


def _of_row(docs: DataFrame, keys: DataFrame) -> Column:
    return (docs["doc_id"].eqNullSafe(keys["_bad_id"]) & docs["source"].eqNullSafe(keys["_bad_host"])
            & (F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))) == keys["_bad_text"]))


def keep_good(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that every rule keeps, with all their columns."""
    bad = judge_quality(docs, **limits).where(~F.col("kept")).select(
        F.col("doc_id").alias("_bad_id"), F.col("host").alias("_bad_host"),
        F.col("text_hash").alias("_bad_text")).distinct()
    return docs.join(bad, _of_row(docs, bad), "left_anti")


def clean_good(docs: DataFrame, **limits) -> DataFrame:
    """The rows that ``keep_good`` keeps, the lines over the limit cut from
    their texts; a text without such lines stays as it is."""
    verdicts, over = _judged(docs, **limits)
    bad = verdicts.where(~F.col("kept")).select(
        "doc_id", "host", "text_hash", F.lit(True).alias("gone"), F.lit(None).cast("bigint").alias("line"))
    cut = over.select("doc_id", "host", "text_hash", F.lit(False).alias("gone"), F.col("hash").alias("line"))
    # One row per document that a rule touches; its lines are fewer than the text has.
    keys = bad.union(cut).groupBy("doc_id", "host", "text_hash").agg(
        F.max("gone").alias("_gone"), F.collect_set("line").alias("_cut")).select(
        F.col("doc_id").alias("_bad_id"), F.col("host").alias("_bad_host"), F.col("text_hash").alias("_bad_text"),
        "_gone", "_cut")
    stays = lambda l: ~(_has_word(l) & F.array_contains(
        keys["_cut"], F.xxhash64(_normal(l))))
    text = F.when(F.size(keys["_cut"]) > 0, F.array_join(F.filter(F.split(docs["text"], "\n"), stays), "\n")).otherwise(
        docs["text"])
    return docs.join(keys, _of_row(docs, keys), "left").where(~F.coalesce(keys["_gone"], F.lit(False))).select(
        *[text.alias(c) if c == "text" else docs[c] for c in docs.columns])
