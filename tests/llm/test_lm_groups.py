"""Groups of the scoring step grow in number, not in size."""

from eddyflow.llm import ngramlm


def test_facts_of_each_slice_are_a_group_of_their_own():
    numbers = [(p << 32) + k for p in range(2000) for k in range(3)]
    groups = [ngramlm.facts_group(n) for n in numbers]
    assert len(set(groups)) == len(numbers) and max(groups) < 0


def test_no_group_holds_the_facts_of_two_slices(spark, monkeypatch):
    frame, held = type(spark.range(0)), []
    plain = frame.mapInArrow

    def seen(self, run, schema, *args, **kwargs):
        out = plain(self, run, schema, *args, **kwargs)
        if "slice" in schema:
            held.append(out)
        return out

    monkeypatch.setattr(frame, "mapInArrow", seen)
    rows = [(i, f"some words {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    assert ngramlm.fit_and_score(docs).count() == 60
    facts = held[-1].where("shard < 0").groupBy("shard").count().collect()
    assert len(facts) > 1 and {r["count"] for r in facts} == {1}


def test_a_frequent_pair_comes_once_a_slice(spark, monkeypatch):
    """A template in every document: a shard gets its pairs once a slice, with counts."""
    frame, held = type(spark.range(0)), []
    plain = frame.mapInArrow

    def seen(self, run, schema, *args, **kwargs):
        out = plain(self, run, schema, *args, **kwargs)
        if "slice" in schema:
            held.append(out)
        return out

    monkeypatch.setattr(frame, "mapInArrow", seen)
    docs = spark.createDataFrame([(i, "same header\nsame header") for i in range(700)], "doc_id long, text string").repartition(4)
    got = ngramlm.fit_and_score(docs).collect()
    assert len(got) == 700 and len({round(r["score"], 9) for r in got}) == 1
    parts = [ngramlm.unpack_pairs(bytes(r["data"])) for r in held[-1].where("shard >= 0").collect()]
    learned = sum(1 for r in got if not r["held_out"])
    # (start, same), (same, header) twice a text, (header, same), (header, end)
    assert sum(len(p[0]) for p in parts) <= 4 * 4
    assert sum(int(p[2].sum()) for p in parts) == 5 * learned
