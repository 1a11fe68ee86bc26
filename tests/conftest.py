import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from vitrine.session import build_session

    session = build_session("tests", "local[8]", 8, spark__driver__memory="8g", **{"spark__checkpoint__dir": str(tmp_path_factory.mktemp("checkpoints")), "spark__sql__warehouse__dir": str(tmp_path_factory.mktemp("warehouse"))})
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(session.conf.get("spark.checkpoint.dir"))
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def small_plans(request):
    """Modules whose tests run very many jobs over a few rows: two partitions, and no code to compile for them."""
    if request.module.__name__ not in ("test_incremental", "test_crawl", "test_storefront"):
        yield
        return
    spark = request.getfixturevalue("spark")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.codegen.wholeStage")}
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)
