import pytest


@pytest.fixture(scope="module", autouse=True)
def shared(spark, tmp_path_factory):
    """Stages of these tests go to a folder of their own."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
