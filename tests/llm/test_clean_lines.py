"""Lines over the limit are cut from the texts that stay."""

import random

import corpus_pipeline
from eddyflow.llm.quality import clean_good, keep_good

SCHEMA = "doc_id long, text string, source string, _bad_id int, _cut string"
FOOTER = "all rights reserved by the owners of this very site since the start of time"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)


def test_lines_over_the_limit_are_cut(spark):
    rng = random.Random(1)
    own = lambda: " ".join(f"V{rng.randint(0, 10**6)}" for _ in range(30))
    rows, want = [], []
    for host in ("h", None):
        for i in range(100):
            a, b = own(), own()
            rows.append((i, f"{a}\n \t\n {FOOTER.upper()}\t\n{b}\n{FOOTER}", host))
            want.append((i, f"{a}\n \t\n{b}", host))
    rows += [(500 + i, f"{own()}\n{FOOTER}", "few") for i in range(10)]
    want += rows[-10:]  # under the limit in its own host
    rows += [(600, f"{FOOTER}\n{FOOTER}", "h"), (601, None, "h"), (602, "one two", "h")]
    twice = f"{own()}\n{FOOTER}"
    rows += [(None, twice, "h"), (None, twice, "few")]
    want += [(None, twice.split("\n")[0], "h"), (None, twice, "few")]
    df = frame(spark, rows)
    for clean in (clean_good(df), corpus_pipeline.quality_rules(spark, df, "")):
        assert clean.columns == df.columns
        assert sorted(map(repr, ((r["doc_id"], r["text"], r["source"]) for r in clean.collect()))) == sorted(
            map(repr, want))
    kept = sorted(str(r["doc_id"]) for r in keep_good(df).collect())
    assert kept == sorted(str(i) for i, _, _ in want)


def test_empty_table_stays_empty(spark):
    assert clean_good(frame(spark, [])).count() == 0
