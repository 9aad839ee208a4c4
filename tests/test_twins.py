"""Every registered query against its SQL twin, with and without split keys."""

from __future__ import annotations

import pytest

from crewlens.operators import skew
from fieldlens.oracle import ORACLE
from fieldlens.queries import QUERIES
from tests.support import duck_table, spark_table


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns, expected = duck_table(duck, ORACLE[name])
    assert sorted(df.columns) == columns
    assert expected, "an empty comparison proves nothing"
    assert spark_table(df) == expected


SPLITTING = [
    "first_five_report", "vip_outreach_report", "agents_on_shift", "sheet_rows",
    "positional_rows", "business_postings", "first_five_shifts", "qualifying_history",
    "profile_flags", "roster_days", "open_clockins", "earlier_experience", "earlier_ratings",
]


@pytest.mark.parametrize("name", SPLITTING)
def test_hot_keys_do_not_change_results(spark, duck, sf_dir, name, monkeypatch):
    monkeypatch.setattr(skew, "EVEN_SHARES", 0.01)
    assert spark_table(QUERIES[name](spark, sf_dir)) == duck_table(duck, ORACLE[name])[1]


def test_a_sheet_without_its_header_fails_by_name(spark, sf_dir):
    from crewlens.plans import sheets
    from crewlens.sources.sheets import rows_of
    from fieldlens.queries import payment_lines

    lines = payment_lines(spark, sf_dir).filter("sheet <> 'nation 3' OR NOT contains(value, 'location_id')")
    with pytest.raises(Exception, match="header row 'location_id' is missing in sheet nation 3"):
        sheets.payment_sheet(rows_of(lines)).collect()
