"""The catalogue against the published table layout, written down here on its own."""

import pytest

from barlake.catalog import CATALOG

BY_DATE, STATEMENT = ("ts_code", "trade_date"), ("ts_code", "end_date")
# Number of columns, key, partitions.
LAYOUT = {
    "daily": (11, BY_DATE, ("ym",)),
    "stock_basic": (17, ("ts_code",), ()),
    "income": (85, STATEMENT, ("end_date",)),
    "cashflow": (91, STATEMENT, ("end_date",)),
    "balancesheet": (79, STATEMENT, ("end_date",)),
    "trade_calendar": (4, ("exchange", "cal_date"), ("year",)),
    "st_stocks": (6, ("ts_code",), ()),
    "adjfactor": (3, BY_DATE, ("ym",)),
    "moneyflow": (20, BY_DATE, ("ym",)),
    "index_basic": (13, ("ts_code", "market"), ("market",)),
    "index_weight": (4, ("index_code", "con_code", "trade_date"), ("index_short", "year")),
    "index_daily": (11, BY_DATE, ("index_short", "year")),
}


def test_there_are_twelve_tables():
    assert set(CATALOG) == set(LAYOUT)


@pytest.mark.parametrize("table", sorted(LAYOUT))
def test_layout(table):
    spec = CATALOG[table]
    width, key, partitions = LAYOUT[table]
    assert (len(spec.columns), spec.key, spec.partitions) == (width, key, partitions)
    assert len(set(spec.columns)) == width and set(key) <= set(spec.columns)
    kinds = {f.name: f.dataType.simpleString() for f in spec.schema.fields}
    whole = {n for n, k in kinds.items() if k == "int"}
    assert whole == ({"is_open"} if table == "trade_calendar" else set())
    text = {n for n, k in kinds.items() if k == "string"}
    assert {n for n in kinds if n.endswith(("_code", "_date", "name"))} <= text


@pytest.mark.parametrize("table", ["income", "cashflow", "balancesheet"])
def test_revisions_of_statements(table):
    assert CATALOG[table].newest_first == ("f_ann_date", "ann_date", "update_flag", "report_type")
