"""Rows that share an id, or have none, are judged by their own texts."""

from eddyflow.llm.decontam import drop_contaminated
from eddyflow.llm.langid import keep_known
from eddyflow.llm.simhash import keep_first

SCHEMA = "doc_id long, text string, fp long, component_id string"


def kept_by_first(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    out = keep_first(df)
    assert out.columns == df.columns
    return sorted((str(r["doc_id"]), r["text"]) for r in out.collect())


def test_first_of_each_group_with_null_ids(spark):
    rows = [(None, "only null here and there"), (None, "a quite different text without an id"),
            (None, "a quite different text without an id"), (None, "p q r s"), (5, "p q r s")]
    assert kept_by_first(spark, rows) == [("5", "p q r s"), ("None", "a quite different text without an id"),
                                          ("None", "only null here and there")]


def test_first_of_each_group_with_repeated_ids(spark):
    rows = [(1, "one text under the first id"), (1, "something else that shares the id"),
            (2, "Something else that shares the id"), (1, "a third near copy of row zero"),
            (0, "A third near copy of row zero"), (3, None), (3, "")]
    kept = kept_by_first(spark, rows)
    assert kept[:-1] == [("0", "A third near copy of row zero"), ("1", "one text under the first id"),
                         ("1", "something else that shares the id")]
    assert len(kept) == 4 and kept[-1][0] == "3"


def test_unknown_language_takes_only_its_own_text(spark):
    words = "the quick brown fox jumps over the lazy dog"
    rows = [(None, words), (None, "1 2 3"), (None, None), (7, words + " again"), (7, "4 5 6"), (8, "7 8")]
    df = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, text string, lang string")
    assert sorted((str(r["doc_id"]), r["text"]) for r in keep_known(df).collect()) == [
        ("7", words + " again"), ("None", words)]


def test_contaminated_text_takes_no_other_row_without_id(spark):
    item = "a benchmark passage that nobody should ever see"
    rows = [(None, "clean words and nothing else at all here"), (None, f"before {item} after"), (None, None), (1, item)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = drop_contaminated(df, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted(map(str, (r["text"] for r in out.collect()))) == ["None", rows[0][1]]
