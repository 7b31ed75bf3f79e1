"""Keep the documents in step with the library's own catalog (the optional
training-data queries have their own section and tests)."""

import importlib
import os
import re

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
E = importlib.import_module("__spark_entry__")
CATALOG = importlib.import_module("tidewater.plans.catalog").QUERIES


def read(name):
    with open(os.path.join(ROOT, name), encoding="utf-8") as fh:
        return fh.read()


def test_readme_query_count():
    m = re.search(r"registers (\d+) queries", read("README.md"))
    sql = [q for q in E.oracle_sql() if q in CATALOG]
    assert m and int(m.group(1)) == len(CATALOG) == len(sql) and set(CATALOG) <= set(E.queries())


def test_coverage_mentions_every_query():
    text = read("COVERAGE.md")
    missing = [q for q in CATALOG if f"`{q}`" not in text]
    assert missing == []
