"""The agenda of a race in one row, however many lists the operator cuts it into."""

import __spark_entry__ as entry
from paceline.operators import documents
from tests.compare import compare, connect


def test_long_agendas_are_shown_whole(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(documents, "AGENDA_ITEMS", 3)
    ok, note, _ = compare(spark, connect(sf_dir), sf_dir, entry.queries()["must_cover"], entry.oracle_sql()["must_cover"])
    assert ok, note
