from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from eventmart import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def make_lines(spark):
    """Lines of one or more files as the scan would deliver them."""

    def make(*files: list, block_size: int = 1000):
        rows = []
        for number, lines in enumerate(files):
            for i, line in enumerate(lines):
                text = line if isinstance(line, str) else json.dumps(line)
                rows.append((float(number), f"f{number}", i // block_size, i, text))
        return spark.createDataFrame(rows, "file_ts double, file_name string, block bigint, ord bigint, line string")

    return make
