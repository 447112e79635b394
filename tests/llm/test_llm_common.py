from __future__ import annotations

from pathlib import Path

import pytest

from sluice.llm.common import passing, stored


def folder_of(df):
    return Path(df.inputFiles()[0].removeprefix("file:").removeprefix("//")).parent


def test_what_passes_is_removed(spark):
    before = stored(spark.range(3))
    with passing(spark):
        outer = stored(before)
        with passing(spark):
            inner = folder_of(stored(outer))
        assert not inner.exists() and folder_of(outer).exists()
        kept = folder_of(outer)
    assert not kept.exists() and before.count() == 3
    with pytest.raises(ZeroDivisionError), passing(spark):
        failed = folder_of(stored(before))
        raise ZeroDivisionError
    assert not failed.exists() and folder_of(stored(before)).exists()
