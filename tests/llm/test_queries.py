"""What the registered queries declare, and hints of this package."""

import pathlib

from tessera.llm.queries import ORACLE_SQL, QUERIES, WITHOUT_SQL

#: Lists bounded by a documented parameter, whatever the table.
BOUNDED = {"common.py", "string_kernel.py", "line_crf.py"}


def test_every_number_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(QUERIES) == set(ORACLE_SQL) | WITHOUT_SQL


def test_only_bounded_lists_are_hinted():
    src = pathlib.Path(__file__).resolve().parents[2] / "tessera" / "llm"
    assert {f.name for f in src.glob("*.py") if "F.broadcast(" in f.read_text()} == BOUNDED
