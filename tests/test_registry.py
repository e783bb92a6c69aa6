"""The README coverage table names only registered queries, and every
registered query is named there."""

import re
from pathlib import Path

import __spark_entry__ as entry
from rewardseg.plans.registry import QUERIES

README = Path(__file__).resolve().parents[1] / "README.md"


def _table_query_keys():
    text = README.read_text()
    table = text[text.index("## Coverage"):text.index("## Scale design")]
    keys = set()
    for line in table.splitlines():
        cells = line.split("|")
        if len(cells) > 3:
            keys |= set(re.findall(r"`([a-z_]+)`", cells[3]))
    return keys


def test_readme_coverage_matches_registry():
    registered = set(QUERIES)
    assert registered <= set(entry.queries())
    named = _table_query_keys()
    assert named <= registered, named - registered
    assert registered <= named, registered - named
