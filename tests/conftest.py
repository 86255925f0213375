from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wardspan.runtime import session  # noqa: E402


@pytest.fixture(scope="session")
def shared_folder(tmp_path_factory):
    """Stands for the folder a cluster names for intermediate tables."""
    return tmp_path_factory.mktemp("shared")


@pytest.fixture(scope="session")
def spark(shared_folder):
    s = session(
        "tests",
        4,
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.codegen.cache.maxEntries": "2000",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(shared_folder),
        },
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *columns):
    """Sorted tuples, NULLs last."""
    chosen = df.select(*columns) if columns else df
    return sorted(map(tuple, chosen.collect()), key=in_order)


def in_order(row):
    return [(v is None, 0 if v is None else v) for v in row]
