"""Every registered query against independent SQL, value by value."""

from __future__ import annotations

import pytest
from compare import connect, differences
from support import SF_DIR

import __spark_entry__ as driver
from oracle_statements import STATEMENTS
from snapcat.registry import registered

# The optional subpackage brings its own tests.
QUERIES = {name: run for name, run in driver.queries().items() if name in registered()}


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


def test_every_query_but_file_sizes_has_sql():
    assert set(QUERIES) - set(STATEMENTS) == {"storage_footprint"}
    assert set(STATEMENTS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_matches_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, STATEMENTS[name]) == []


def test_flagship(spark, duck):
    from snapcat.registry import shown

    assert differences(shown(driver.entry(spark)), duck, STATEMENTS["fact_artist_snapshot"]) == []


def test_storage_footprint(spark):
    rows = {(r.entity, r.layer): r for r in QUERIES["storage_footprint"](spark, SF_DIR).collect()}
    assert len(rows) == 8
    for entity in ("artists", "albums", "tracks"):
        assert rows[entity, "silver"].bytes < rows[entity, "raw"].bytes
        assert rows[entity, "raw"].saving_pct == 0.0
    total = rows["TOTAL", "silver"]
    assert total.bytes == sum(rows[e, "silver"].bytes for e in ("artists", "albums", "tracks"))
