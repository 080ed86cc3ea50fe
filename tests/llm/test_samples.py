"""Shared helpers: samples for the classifier fits, bounded before they are ranked and with excerpts of long texts,
and stored intermediate tables."""

from collections import Counter

from pyspark.sql import functions as F

from kithwork.llm.language_id import language_id
from kithwork.llm import tables
from kithwork.llm.tables import excerpt, hash_sample, labelled_sample
from kithwork.llm.toxicity import toxicity
from tables_for_tests import LABELS, documents, words


def test_a_sample_holds_the_smallest_hashes_of_each_group(spark):
    df = spark.range(30_000).selectExpr("id", "if(id % 3 = 0, 'a', if(id < 29000, 'b', 'c')) g", "id x")
    found = hash_sample(df, 50, "g", "id")
    assert found.columns == df.columns
    ranked = df.withColumn("h", F.xxhash64(F.col("id").cast("string"))).collect()
    for g in "abc":
        own = sorted((r.h, r.id) for r in ranked if r.g == g)[:50]
        assert sorted(r.id for r in found.where(F.col("g") == g).collect()) == sorted(i for _, i in own)
    few = hash_sample(df.where("id < 100"), 50, "g", "id")
    assert Counter(r.g for r in few.collect()) == {"a": 34, "b": 50}


def test_few_rows_of_a_large_group_are_ranked(spark):
    """A third of the rows has one label; what reaches the window does not grow with it."""
    df = spark.range(200_000).selectExpr("id", "if(id % 3 = 0, 1, id) g").where("g < 50000")
    large = df.where("g = 1")
    assert large.count() > 60_000
    found = hash_sample(df, 60, "g", "id").where("g = 1")
    assert found.count() == 60
    # Of the rows that the window is given, by the filter in the plan, there are about 2 * 60 + 100.
    share = (2.0 * 60 + 100) / large.count()
    assert 60 < large.where(F.xxhash64(F.col("id").cast("string")) / F.lit(2.0**64) + 0.5 < share).count() < 400


def test_excerpts_are_bounded_and_inside_the_text(spark):
    text = "".join(chr(0x4E00 + k % 5000) for k in range(9000))
    rows = spark.createDataFrame([(k, text) for k in range(30)] + [(99, "short"), (100, "é" * 60), (101, None)], "id long, t string")
    found = {r.id: r.e for r in rows.select("id", excerpt("t", "id", 100).alias("e")).collect()}
    assert found[99] == "short" and found[100] == "é" * 25 and found[101] is None
    cut = [found[k] for k in range(30)]
    assert all(len(c) == 25 and len(c.encode()) <= 100 and c in text for c in cut) and len(set(cut)) > 10


def test_a_class_of_long_texts_only_is_learned(spark):
    rows = [(i, " ".join(words(i, 6000, 40)) if i % 2 else " ".join(f"v{w}" for w in words(i, 30, 40)), "en") for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2, i % 2, "x") for i in range(80)], LABELS)
    docs = documents(spark, rows)
    texts, counts = labelled_sample(docs, labels, "toxic", 5, 0, 50, 20_000)
    assert min(len(texts[0]), len(texts[1])) > 20 and max(map(len, texts[1])) <= 20_000 and counts[1] > 20
    scores = {r["doc_id"]: r["score"] for r in toxicity(docs, labels).collect()}
    assert len(set(scores.values())) > 1 and min(scores[i] for i in range(1, 80, 2)) > max(scores[i] for i in range(0, 80, 2))


def test_a_language_of_long_texts_only_is_learned(spark):
    rows = [(i, " ".join(words(i, 6000, 30)), "ww") for i in range(12)] + [(100 + i, " ".join(f"der{w}" for w in words(i, 40, 30)), "de") for i in range(12)]
    found = {r["doc_id"]: r["lang_pred"] for r in language_id(documents(spark, rows)).collect()}
    assert [found[i] for i in (0, 5, 11, 100, 111)] == ["ww"] * 3 + ["de"] * 2


def test_stored_tables_can_be_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "shared_folder", lambda _: str(tmp_path))
    kept = tables.stored(spark.range(5), "numbers")
    assert kept.count() == 5 and len(list(tmp_path.rglob("numbers-*"))) == 1
    assert tables.remove_stored(spark) and not list(tmp_path.rglob("numbers-*"))
    assert not tables.remove_stored(spark)
