import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tissuegrid.runtime import drop_stages, local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, 4, memory="6g", stages=str(tmp_path_factory.mktemp("stages")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_stages()
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


def raster(spark, cell, nucleus=None, channels=None, patch=0):
    """Pixel table from small arrays."""
    rows = []
    for y, line in enumerate(cell):
        for x, label in enumerate(line):
            extra = [float(c[y][x]) for c in channels] if channels is not None else []
            rows.append((patch, y, x, int(label), int(nucleus[y][x]) if nucleus is not None else 0, *extra))
    names = [f"chan{i} double" for i in range(len(channels) if channels is not None else 0)]
    schema = ", ".join(["patch_id int, y int, x int, cell_label long, nucleus_label long", *names])
    return spark.createDataFrame(rows, schema)
