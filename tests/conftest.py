import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

REAL = "the committee approved the annual budget after a long public debate on roads"
FAKE = "shocking secret miracle cure hidden by aliens says anonymous insider tonight"
WORDS = (
    "budget roads senate vote report treaty minister bank market court "
    "aliens miracle secret shocking insider hoax cure hidden viral rumor"
).split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("lectern-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def articles(spark):
    """120 labelled texts, one third of class 0, with some words per class."""
    rows = []
    for i in range(120):
        label = 0 if i % 3 == 0 else 1
        pool = WORDS[10:] if label == 0 else WORDS[:10]
        drawn = " ".join(pool[(i * 7 + j * j) % 10] for j in range(6))
        mixed = WORDS[(i * 13) % 20]
        rows.append((i, f"Title {i}", f"{FAKE if label == 0 else REAL} {drawn} {mixed} nr{i}x", f"s{i % 4}", label))
    return spark.createDataFrame(rows, "id bigint, title string, text string, subject string, label int")
