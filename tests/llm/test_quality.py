import random

import brute

from eddyflow.llm.quality import document_records, judge_quality, keep_good

SCHEMA = "doc_id long, text string, source string, words string, n_words int, host int, _bad_id int"


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 7, 7, 7) for r in rows], SCHEMA)


def judged(df, **limits):
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return sorted(map(repr, (tuple(r[c] for c in cols) for r in judge_quality(df, **limits).collect())))


def expected(rows, **limits):
    return sorted(map(repr, (tuple(d.values()) for d in brute.quality(rows, **limits))))


def corpus():
    rng = random.Random(5)
    vocab = ["alpha", "Beta", "gamma#", "delta|", "é", "日本", "x y", "$$"]
    line = lambda k: " ".join(rng.choice(vocab) for _ in range(k))
    common = [line(6) for _ in range(3)]
    rows = []
    for i in range(60):
        own = [line(rng.randint(1, 12)) for _ in range(rng.randint(0, 5))]
        host = rng.choice(["a", "b", None])
        rows.append((i, "\n".join(rng.sample(common, rng.randint(0, 3)) + own), host))
    rows += [(100, None, "a"), (101, "", "a"), (102, " \t\n \x0b\x0c\r ", "b"), (103, "one two", None),
             (104, "\n".join(["a b c d e f g h i j k"] * 3), "a"), (None, "null id row with ten words in it x y z", "a")]
    long = " ".join(f"w{rng.randint(0, 5000)}" for _ in range(20000))
    rows += [(105, long, "a"), (106, "la li lu " * 5000, "a"), (107, common[0], "a"), (107, common[0], "a")]
    return rows


def test_against_brute_force(spark):
    rows = corpus()
    limits = dict(max_docs=5, min_left=4, min_left_share=0.3)
    assert judged(rows_of(spark, rows), **limits) == expected(rows, **limits)


def test_boilerplate_only_documents_go_and_copies_stay(spark):
    rng = random.Random(1)
    own = lambda: " ".join(f"v{rng.randint(0, 10**6)}" for _ in range(30))
    footer = "all rights reserved by the owners of this very site since the start of time"
    rows = [(i, own() + "\n" + footer, "h") for i in range(200)]
    rows += [(1000 + i, f"{footer}\n{footer.upper()}", "h") for i in range(3)]
    text = "\n".join(own() for _ in range(6))
    rows += [(2000 + i, text, "h") for i in range(300)]  # exact copies are not boilerplate
    rows += [(3000 + i, text.upper(), "h") for i in range(300)]  # nor are copies in other letters
    kept = {r["doc_id"] for r in keep_good(rows_of(spark, rows)).collect()}
    assert kept == {r[0] for r in rows} - {1000, 1001, 1002}


def test_a_template_loses_its_lines_and_goes(spark):
    """Distinct documents of one host that are mostly the same lines."""
    rng = random.Random(2)
    own = lambda k=12: " ".join(f"v{rng.randint(0, 10**6)}" for _ in range(k))
    shared = [own() for _ in range(10)]
    template = [(i, "\n".join([*shared, own(4)]), "h") for i in range(1000)]
    good = [(5000 + i, "\n".join([own(), own(), shared[0]]), "h") for i in range(30)]
    elsewhere = [(7000 + i, "\n".join([*shared, own(4)]), "other") for i in range(20)]
    # The id and text of a template document, in another host: a row of its own.
    twin = [(0, template[0][1], "third")]
    rows = template + good + elsewhere + twin
    kept = sorted((r["doc_id"], r["source"]) for r in keep_good(rows_of(spark, rows)).collect())
    assert kept == sorted((r[0], r[2]) for r in good + elsewhere + twin)
    assert judged(rows_of(spark, rows)) == expected(rows)


def test_the_rule_rejects_documents_of_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    assert judge_quality(docs).where("not kept and not base_failed").count() > 0


def test_keep_good_keeps_columns_and_rows(spark):
    df = rows_of(spark, corpus())
    out = keep_good(df)
    assert out.columns == df.columns
    good = [r for r, j in zip(corpus(), brute.quality(corpus())) if j["kept"]]
    assert sorted(map(repr, ((r["doc_id"], r["text"], r["source"]) for r in out.collect()))) == sorted(map(repr, good))


def test_empty_table(spark):
    df = rows_of(spark, [])
    assert judge_quality(df).count() == 0 and keep_good(df).count() == 0


def test_no_python_in_the_plan(spark):
    plan = document_records(rows_of(spark, corpus()[:3]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
