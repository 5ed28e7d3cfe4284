from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from walletlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = local_session(8, memory="6g", conf={"spark.sql.warehouse.dir": warehouse})
    yield session
    session.stop()


def rows(df, *keys):
    """Rows as sorted tuples, of the named columns if any are given."""
    picked = df.select(*keys) if keys else df
    return sorted((tuple(r) for r in picked.collect()), key=str)
