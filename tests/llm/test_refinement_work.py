"""A pass of op7 that only names halves works out no cover of the texts."""

from __future__ import annotations

import pandas as pd
import pytest

from tests.llm.cases import odd_rows
from tidewire.llm import suffix_dedup


@pytest.mark.parametrize("level", range(suffix_dedup.LEVELS))
def test_halves_need_no_cover(monkeypatch, level):
    texts = [t for _, t, *_ in odd_rows()]
    batch = pd.DataFrame({"key": range(len(texts)), "text": texts})
    first = pd.concat(suffix_dedup.suffix_rows(50, 20)(iter([batch])))
    around = ((first["head"].to_numpy() & 0xFFFF) << 32) | (first["tail"].to_numpy().astype("int64") & 0xFFFFFFFF)
    batch["open0"] = [around[first["key"] == k] for k in batch["key"]]
    batch["done0"] = batch["done1"] = batch["open1"] = None
    covers = []
    plain = suffix_dedup.covered
    monkeypatch.setattr(suffix_dedup, "covered", lambda *args: covers.append(args) or plain(*args))
    assert sum(map(len, suffix_dedup.half_rows(50, 20, level)(iter([batch])))) > 0 or level
    assert not covers
