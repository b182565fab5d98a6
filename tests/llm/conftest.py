from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


def rows_by(df, key):
    return {r[key]: r for r in df.collect()}
