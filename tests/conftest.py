import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from marquee.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[8]", 8, app="marquee-tests", scratch=str(tmp_path_factory.mktemp("scratch")))
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def value_of(spark):
    """Evaluate a column expression over one string column ``c`` for each given text."""
    def run(make, texts):
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
        return [r[0] for r in rows.select(make("c").alias("v"), "i").orderBy("i").select("v").collect()]

    return run
