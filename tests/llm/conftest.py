from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import samples  # noqa: E402


@pytest.fixture(scope="session")
def documents(spark):
    frame = samples.documents(spark).cache()
    frame.count()
    return frame


@pytest.fixture(scope="session")
def rows(documents):
    return documents.collect()
