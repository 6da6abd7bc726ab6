"""op4's classes come from the shared helper, whose tables have true sizes."""

from __future__ import annotations

from postlens.llm import common
from postlens.llm import op4_probminhash as op4


def test_classes_by_stored_tables():
    assert op4.components is common.components
