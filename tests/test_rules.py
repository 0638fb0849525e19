"""Rules for the source text of the library."""

import pathlib
import re

ROOT = pathlib.Path(__file__).parent.parent / "tablewright"
# Calls that lose data with an executor, pair all rows, or leave the DataFrame API.
FORBIDDEN = (r"\.localCheckpoint\(", r"\.crossJoin\(", r"\.foreach\(", r"\.toLocalIterator\(", r"rdd\.map", r"F\.udf\(")


def test_no_forbidden_calls():
    for path in ROOT.rglob("*.py"):
        text = path.read_text()
        for pattern in FORBIDDEN:
            assert not re.search(pattern, text), f"{path.name}: {pattern}"


def test_every_package_has_its_text():
    for path in ROOT.rglob("*.py"):
        assert path.read_text().lstrip().startswith('"""'), path
