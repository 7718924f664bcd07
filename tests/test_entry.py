"""The entry without its optional part."""

import subprocess
import sys

import __spark_entry__

PROBE = """
import sys
sys.modules["{name}"] = None
import __spark_entry__ as entry
from tripmart.plans import catalog
assert entry.texts is None and set(entry.queries()) == set(catalog.QUERIES)
assert set(entry.oracle_sql()) <= set(entry.queries())
"""


def test_queries_without_the_text_operators():
    for name in ("tripmart.llm", "numpy"):
        subprocess.run([sys.executable, "-c", PROBE.format(name=name)], check=True)


def test_every_query_of_the_reports_has_sql():
    names = {name for name in __spark_entry__.queries() if not name.startswith(("op", "pipeline"))}
    assert names == {name for name in __spark_entry__.oracle_sql() if not name.startswith("op")}
