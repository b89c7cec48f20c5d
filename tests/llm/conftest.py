import pytest

from rotorlake.llm import exchange


@pytest.fixture(autouse=True)
def few_parts(monkeypatch):
    """Small inputs need no 64 tasks; four parts still ask each other."""
    monkeypatch.setattr(exchange, "MIN_PARTS", 4)
