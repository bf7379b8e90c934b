"""Package code must stay distributed: no driver loops over rows, no Python row functions."""

import re
from pathlib import Path

import pytest

PACKAGE = Path(__file__).resolve().parent.parent / "ledgerstone"
FILES = sorted(p for p in PACKAGE.rglob("*.py") if p.parent.name != "llm")  # that subpackage has its own guard
BANNED = [
    r"\.collect\(\)", r"\.toPandas\(", r"\.toLocalIterator\(", r"\blocalCheckpoint\b", r"\bcrossJoin\b", r"F\.udf\b", r"pandas_udf",
    r"\.rdd\b", r"\bbroadcast\(", r"\.coalesce\(1\)", r"\.limit\(", r"current_timestamp\(\) -", r"F\.rand\(", r"\.sample\(",
]


@pytest.mark.parametrize("path", FILES, ids=lambda p: str(p.relative_to(PACKAGE)))
def test_no_single_task_or_driver_work(path):
    text = path.read_text()
    if path.name == "reading.py":  # the list of landed files by header, which Spark's own listing holds too
        text = text.replace(".toLocalIterator()", "", 2)
    assert [p for p in BANNED if re.search(p, text)] == []
