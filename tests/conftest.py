import os
import sys

import numpy as np
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def points(spark):
    """Build a written (id, v[, cluster_id]) table from a matrix."""
    from labelloom.scratch import cut

    def build(x, clusters=None, ids=None, partitions=3):
        ids = range(len(x)) if ids is None else ids
        if clusters is None:
            rows = [(int(i), [float(e) for e in v]) for i, v in zip(ids, x)]
            df = spark.createDataFrame(rows, "id long, v array<double>")
        else:
            rows = [(int(i), [float(e) for e in v], int(c)) for i, v, c in zip(ids, x, clusters)]
            df = spark.createDataFrame(rows, "id long, v array<double>, cluster_id int")
        return cut(df.repartition(partitions), "test")

    return build


@pytest.fixture(scope="session")
def blobs():
    """Three separated groups of 40 points in four dimensions, and five far points."""
    rng = np.random.default_rng(7)
    centres = np.array([[0, 0, 0, 0], [6, 0, 0, 0], [0, 6, 0, 0]], dtype=float)
    x = np.vstack([rng.normal(c, 0.4, (40, 4)) for c in centres])
    far = rng.uniform(12, 20, (5, 4)) * np.array([1, -1, 1, -1])
    return np.vstack([x, far]), np.repeat([0, 1, 2, -1], [40, 40, 40, 5])
