import os
from collections.abc import Callable

import pytest
from pyspark.sql import SparkSession

from twinview.session import build_session


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    session = build_session(
        "tests", "local[4]",
        {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def land(tmp_path) -> Callable[..., str]:
    """Write lines as the next file of a landing folder; returns the folder."""
    folder, count = tmp_path / "landing", [0]
    folder.mkdir()

    def write(*lines: str) -> str:
        count[0] += 1
        file = folder / f"part-{count[0]:03}.txt"
        file.write_text("".join(f"{line}\n" for line in lines))
        os.utime(file, (1_700_000_000 + count[0],) * 2)  # files are read in this order
        return str(folder)

    return write


def click(ts=0, action="page_view", visitor=1, product="Acme,Soap", referrer="Google", prev="", page=1):
    return f"{ts}\t{referrer}\t{action}\t{prev}\tVisitor - {visitor}\tPage - {page}\t{product}"


def as_set(df, *columns):
    rows = (df.select(*columns) if columns else df).collect()
    return sorted((tuple(r) for r in rows), key=lambda r: [(v is not None, v) for v in r])
