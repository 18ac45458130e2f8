import sys

import __spark_entry__ as entry
from marketlane.plans.catalog_runs import CHECKS, QUERIES


def test_entry_works_without_the_training_data_operators(monkeypatch):
    for name in [n for n in sys.modules if n == "corpus_pipeline" or n.startswith("marketlane.llm.")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "marketlane.llm", None)  # as if its folder were gone
    assert entry.queries() == QUERIES and entry.oracle_sql() == CHECKS


def test_flagship_query_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
