from __future__ import annotations

import uuid

import pytest

from skyledger.config import LakeConfig
from skyledger.session import build_session
from skyledger.sources import tables


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        master="local[4]",
        shuffle_partitions=4,
        conf={
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    """A fresh environment with its schemas created."""
    tag = uuid.uuid4().hex[:8]
    cfg = LakeConfig(catalog=f"b{tag}", stream_catalog=f"s{tag}", root=str(tmp_path / "lake"))
    tables.create_schemas(spark, cfg)
    return cfg


@pytest.fixture
def conf(spark):
    """Sets session options for one test."""
    before = {}

    def change(**options):
        for name, value in options.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)
