import pytest
from pyspark.sql import functions as F

from lectern.sources import readers as rd
from lectern.sources import schema as sh

TRUE_CSV = (
    "title,text,subject,date\n"
    'A,"line one\nline two ""quoted"", end",politics,"January 1, 2017"\n'
    "B,plain text,world,\n"
)
FAKE_CSV = "title,text,subject\nC,other text,news\nD,,news\n"


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "True.csv").write_text(TRUE_CSV)
    (tmp_path / "Fake.csv").write_text(FAKE_CSV)
    return str(tmp_path)


def test_quoted_line_breaks_stay_in_one_row(spark, folder):
    rows = rd.read_csv(spark, f"{folder}/True.csv").collect()
    assert len(rows) == 2
    assert rows[0]["text"] == 'line one\nline two "quoted", end'


def test_load_corpus_unites_and_fills_missing_columns(spark, folder):
    df = rd.load_corpus(spark, folder)
    assert df.columns == ["title", "text", "subject", "date", "label"]
    rows = {r["title"]: r for r in df.collect()}
    assert {t: r["label"] for t, r in rows.items()} == {"A": 1, "B": 1, "C": 0, "D": 0}
    assert rows["C"]["date"] is None and rows["A"]["date"] == "January 1, 2017"
    assert dict(df.dtypes)["subject"] == "string" and dict(df.dtypes)["label"] == "int"


def test_missing_file_is_reported(spark, tmp_path):
    (tmp_path / "True.csv").write_text(TRUE_CSV)
    with pytest.raises(Exception, match="Fake.csv"):
        rd.load_corpus(spark, str(tmp_path)).collect()


def test_text_and_label_only_drops_empty_texts(spark, folder):
    df = rd.load_texts_and_labels(spark, f"{folder}/True.csv", f"{folder}/Fake.csv")
    assert df.columns == ["text", "label"] and dict(df.dtypes)["label"] == "double"
    assert df.count() == 3
    with pytest.raises(ValueError, match="body"):
        rd.load_texts_and_labels(spark, f"{folder}/True.csv", f"{folder}/Fake.csv", "body")


def test_alias_priority_ignores_case(spark):
    df = spark.createDataFrame(
        [("h", "b", "c", "t", 1)], "Heading string, BODY string, Content string, Topic string, label int"
    )
    row = sh.normalize_schema(df).first()
    assert row["text"] == "c"  # content comes before body
    assert row["title"] == "h" and row["subject"] == "t"
    assert row["date"] is None and "id" not in row.asDict()
    assert sh.normalize_schema(df.withColumn("ID", F.lit("a-7"))).first()["id"] == "a-7"
    with pytest.raises(ValueError, match="case only"):
        sh.resolve_column(["Text", "TEXT"], ("text",))


def test_title_falls_back_to_text_and_text_is_required(spark):
    df = spark.createDataFrame([("x", 1)], "story string, label int")
    assert sh.normalize_schema(df).first()["title"] == "x"
    with pytest.raises(ValueError, match="words"):
        sh.normalize_schema(spark.createDataFrame([("x", 1)], "words string, label int"))


def test_drop_invalid_counts_only_spaces_as_blank(spark):
    df = spark.createDataFrame(
        [(None, 1), ("", 1), ("   ", 1), ("\n\n", 1), ("ok", None), ("ok", 0)], "text string, label int"
    )
    assert sorted(r["text"] for r in sh.drop_invalid(df).collect()) == ["\n\n", "ok"]


def test_scoring_input(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,text\n1,"  hello\n"\n2,   \n3,\n4,"a, ""b"""\n')
    rows = rd.read_scoring_csv(spark, str(path), "text", "id").collect()
    assert [(r["id"], r["text"]) for r in rows] == [("1", "hello"), ("4", 'a, "b"')]
    assert rd.read_scoring_csv(spark, str(path)).columns == ["text"]
    with pytest.raises(ValueError, match="missing columns"):
        rd.read_scoring_csv(spark, str(path), "body")


def test_scoring_input_strips_unicode_blanks(spark):
    df = spark.createDataFrame([(1, "  x y　\t")], "id bigint, text string")
    assert rd.scoring_input(df).first()["text"] == "x y"
    blanks = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
    df = spark.createDataFrame([(1, blanks + "z" + blanks)], "id bigint, text string")
    assert rd.scoring_input(df).first()["text"] == "z"


def test_literal_text_and_preview(spark, folder):
    assert [tuple(r) for r in rd.literal_text(spark, "a", "b").collect()] == [(0, "a"), (1, "b")]
    assert rd.preview(spark, f"{folder}/True.csv", 1).count() == 1
