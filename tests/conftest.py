import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from wattframe.session import local_session  # noqa: E402
from wattframe.sources.files import text_schema  # noqa: E402


@pytest.fixture(scope="session")
def shared_folder(tmp_path_factory):
    return str(tmp_path_factory.mktemp("shared"))


@pytest.fixture(scope="session")
def spark(shared_folder):
    settings = {
        "spark.checkpoint.dir": shared_folder,
        "spark.sql.maxMetadataStringLength": "5000",
    }
    session = local_session(4, **settings)
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Raw text rows from dicts; absent fields are NULL."""

    def build(columns, *records):
        rows = [tuple(record.get(name) for name in columns) for record in records]
        return spark.createDataFrame(rows, text_schema(columns))

    return build


def as_dicts(frame):
    return [row.asDict() for row in frame.collect()]


@pytest.fixture
def rows_of():
    return as_dicts
