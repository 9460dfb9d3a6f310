import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.operators import clean as cl
from lectern.sources import sinks
from lectern.sources.schema import CORPUS_SCHEMA


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "id bigint, text string")


def reference_clean(text):
    """The steps one at a time, with Java's ASCII white space."""
    text = text.strip(" ").lower()
    text = re.sub(r"<[^>]+>", " ", text)
    text = re.sub(r"[\r\n\t]", " ", text)
    text = re.sub(r"[\x00-\x1F\x7F]", " ", text)
    return re.sub(r"[ \t\n\x0b\f\r]+", " ", text)


def test_clean_body_equals_the_steps(spark):
    rng = random.Random(1)
    alphabet = "aB<>/ \t\n\r\x0b\x01\x1f\x7f é"
    samples = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(400)]
    got = texts(spark, *samples).select("id", tx.clean_body(F.col("text")).alias("t")).collect()
    assert {r["id"]: r["t"] for r in got} == {i: reference_clean(s) for i, s in enumerate(samples)}


def test_clean_title_equals_the_steps(spark):
    rng = random.Random(2)
    samples = ["".join(rng.choice("aB< \t\n\x0b\x01") for _ in range(20)) for _ in range(200)]
    got = texts(spark, *samples).select("id", tx.clean_title(F.col("text")).alias("t")).collect()
    want = {i: re.sub(r"[ \t\n\x0b\f\r]+", " ", s.strip(" ").lower()) for i, s in enumerate(samples)}
    assert {r["id"]: r["t"] for r in got} == want


def test_blanks_and_lengths(spark):
    df = texts(spark, None, "", "   ", "\n\n" * 40, "x" * 29, "y" * 30, "<p>Hello</p>\n\n" + "w " * 20)
    rows = {r["id"]: r["text"] for r in cl.clean_text(df).collect()}
    assert set(rows) == {5, 6}
    assert rows[6].startswith(" hello w w")


def test_min_length_zero_still_drops_blanks(spark):
    rows = cl.clean_text(texts(spark, None, "  ", "a"), 0).collect()
    assert [r["id"] for r in rows] == [2]


def test_require_title(spark):
    df = spark.createDataFrame(
        [(1, "  ", "t" * 30), (2, None, "t" * 30), (3, "ok", "t" * 30)], "id bigint, title string, text string"
    )
    assert cl.clean_text(df).count() == 3
    assert [r["id"] for r in cl.clean_text(df, require_title=True).collect()] == [3]


def labelled(spark):
    rows = [(i, "t", f"text number {i % 7}", None, None, i % 2) for i in range(60, 0, -1)]
    return spark.createDataFrame(rows, CORPUS_SCHEMA)


@pytest.mark.parametrize("parts", [1, 7])
@pytest.mark.parametrize("aqe", ["true", "false"])
def test_smallest_key_survives_whatever_the_partitioning(spark, parts, aqe):
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    try:
        df = labelled(spark).repartition(parts)
        assert sorted(r["id"] for r in cl.dedup_text(df).collect()) == list(range(1, 8))
        by_row = cl.dedup_text(df, key=None)
        assert by_row.columns == df.columns
        assert sorted(r["id"] for r in by_row.collect()) == list(range(1, 8))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_any_survivor_keeps_one_row_per_text(spark):
    assert cl.dedup_text_any(labelled(spark)).select("text").distinct().count() == 7
    assert cl.dedup_text_any(labelled(spark)).count() == 7


def test_dedup_without_ids_keeps_whole_rows(spark):
    rows = [("b", "same", 1), ("a", "same", 0), ("a", "x", 0)]
    df = spark.createDataFrame(rows, "title string, text string, label int")
    got = {(r["title"], r["text"], r["label"]) for r in cl.dedup_text(df, key=None).collect()}
    assert got == {("a", "same", 0), ("a", "x", 0)}
    with pytest.raises(Exception, match="id"):
        cl.dedup_text(df)


@pytest.mark.parametrize("parts", [1, 5])
def test_repeated_keys_are_judged_by_their_text(spark, parts):
    rows = [(1, "A", "x"), (1, "B", "y"), (2, "A", "z"), (2, "C", "u"), (3, "D", "v"), (3, "D", "v"), (4, None, "w")]
    df = spark.createDataFrame(rows, "id bigint, text string, title string").repartition(parts)
    got = sorted((r["id"], r["text"] or "", r["title"]) for r in cl.dedup_text(df).collect())
    assert got == [(1, "A", "x"), (1, "B", "y"), (2, "C", "u"), (3, "D", "v"), (4, "", "w")]
    assert cl.dedup_text(df).columns == df.columns


def test_a_null_key_fails_rather_than_losing_its_row(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "id bigint, text string")
    with pytest.raises(Exception, match="null in key column"):
        cl.dedup_text(df).collect()


def test_duplicate_groups_show_conflicting_labels(spark):
    df = spark.createDataFrame(
        [(1, "Same  text " + "x" * 30, 1), (2, "same text " + "x" * 30, 0), (3, "other " + "y" * 30, 1)],
        "id bigint, text string, label int",
    )
    rows = cl.duplicate_groups(cl.clean_text(df)).collect()
    assert [(r["copies"], r["min_id"], r["n_labels"]) for r in rows] == [(2, 1, 2)]
    assert rows[0]["text_hash"] == hashlib.sha256(("same text " + "x" * 30).encode()).hexdigest()


@pytest.mark.parametrize("dedup", [True, False])
def test_report_matches_the_cleaner(spark, dedup):
    df = texts(spark, None, " ", "a" * 30, "A" * 30, "b" * 40, "short")
    cleaned = cl.clean_text(df)
    after = (cl.dedup_text(cleaned) if dedup else cleaned).count()
    row = cl.clean_report(df, dedup=dedup).first()
    assert (row["rows_before"], row["rows_after"], row["dropped"]) == (6, after, 6 - after)
    empty = cl.clean_report(df.limit(0), dedup=dedup).first()
    assert (empty["rows_before"], empty["rows_after"]) == (0, 0)


def test_cleaning_evaluates_the_text_once(spark):
    plan = cl.clean_text(labelled(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("<[^>]+>") == 1


def test_both_arrangements_of_cleaning_and_dedup_agree(spark):
    values = ["a" * 30, " A" + "a" * 29, "short", None, "  ", "<b>x</b> " + "y" * 30, "B" * 31]
    df = spark.createDataFrame(
        [(i, f"T {i}", v) for i, v in enumerate(values)], "id bigint, title string, text string"
    )
    want = sorted(map(tuple, cl.dedup_text(cl.clean_text(df)).collect()))
    assert sorted(map(tuple, cl.clean_and_dedup(df).collect())) == want
    assert [r[0] for r in want] == [0, 5, 6]


def test_counting_after_dedup_reads_no_text_for_the_rows(spark, tmp_path):
    labelled(spark).write.parquet(str(tmp_path / "c"))
    counted = cl.clean_and_dedup(spark.read.parquet(str(tmp_path / "c")), 1).groupBy("label").count()
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<id:bigint,label:int>") == 1


def _plan_without_broadcast(spark, build):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return build()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_that_lie_by_key_are_not_shuffled_again(spark):
    """Neither in a bucketed table nor after a join by the key."""
    sinks.save_by_key(labelled(spark), "corpus_by_id", 4)
    stored = spark.table("corpus_by_id")
    plan = _plan_without_broadcast(spark, lambda: cl.clean_and_dedup(stored, 1))
    wide = plan.split("LeftSemi")[1].split("HashAggregate")[0]
    assert wide.count("Exchange hashpartitioning") == 1  # of the survivors' keys
    marks = stored.select("id", "label")
    texts_only = labelled(spark).drop("label")
    keys = cl.content_keys(texts_only)
    plan = _plan_without_broadcast(
        spark, lambda: cl.clean_and_dedup(texts_only.join(marks, "id"), 1, keys=keys)
    )
    wide = plan.split("LeftSemi")[1].split("HashAggregate")[0]
    assert wide.count("Exchange hashpartitioning") <= 2  # the join's, and the keys'


def test_copies_collapse_before_the_shuffle(spark):
    """One text holding most rows leaves one key per task."""
    df = spark.range(0, 3000, 1, 6).selectExpr(
        "id", "if(id % 3 = 0, concat('unique text ', id), 'the same text') as text"
    )
    survivors = cl.dedup_text(df)
    assert survivors.count() == 1001
    plan = _plan_without_broadcast(spark, lambda: survivors.select("id"))
    assert "partial_min(id" in plan


def test_clip(spark):
    row = texts(spark, "abcdef").select(
        tx.clip(F.col("text"), 3).alias("a"), tx.clip(F.col("text"), None).alias("b")
    ).first()
    assert (row["a"], row["b"]) == ("abc", "abcdef")


def test_parse_date(spark):
    values = ["December 31, 2017", "Dec 31, 2017", "31-Dec-17", "2017-12-31", " 2017-12-31 10:00:00 ", "n/a", None]
    got = texts(spark, *values).select("id", tx.parse_date(F.col("text")).alias("d")).collect()
    days = {r["id"]: str(r["d"]) for r in got}
    assert [days[i] for i in range(5)] == ["2017-12-31"] * 5
    assert days[5] == days[6] == "None"


def test_a_repeated_key_fails_rather_than_keeping_rejected_rows(spark):
    rows = [(1, "a" * 30), (1, "short"), (2, "a" * 30), (2, "b" * 30)]
    df = spark.createDataFrame(rows, "id bigint, text string")
    with pytest.raises(Exception, match="not unique"):
        cl.clean_and_dedup(df).collect()
    assert cl.dedup_text(cl.clean_text(df), None).count() == 2
