from __future__ import annotations

import pytest

from kelda.session import local_session

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4, "kelda-tests", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch"))}
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture
def rows():
    """Rows of a result as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
