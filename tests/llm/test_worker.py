"""Stores of Python workers."""

from __future__ import annotations

import pytest

from eventmart.llm import worker


def test_one_store_at_a_time():
    made = []
    make = lambda name: lambda: made.append(name) or name
    for name in ("a", "a", "b", "b", "a"):
        assert worker.held(name, make(name)) == name
    assert made == ["a", "b", "a"] and len(worker._held) == 1
    assert list(worker.tidy(lambda rows: (r + 1 for r in rows), keep=True)([1, 2])) == [2, 3] and worker._held
    assert list(worker.tidy(lambda rows: (r + 1 for r in rows))([1, 2])) == [2, 3] and not worker._held


def test_tidied_after_a_failure(monkeypatch):
    calls = []
    monkeypatch.setattr(worker, "give_back", lambda: calls.append(1))
    with pytest.raises(ZeroDivisionError):
        list(worker.tidy(lambda rows: (1 // r for r in rows), keep=True)([0]))
    assert calls
