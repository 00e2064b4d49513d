import datetime as dt

import pytest

from skyledger.operators import bi
from skyledger.operators.silver import silver_flights
from tests.data import bronze, rows

DAYS = [dt.date(2025, 1, 5), dt.date(2025, 2, 1), dt.date(2025, 2, 28), dt.date(2026, 1, 1)]


@pytest.fixture
def flights(spark):
    days = [{"Fecha_Programada": d, "ID_Vuelo": f"AA{d.month}"} for d in DAYS]
    return silver_flights(bronze(spark, *days, {"Fecha_Programada": None}))


def total(flights, **filters):
    return bi.total_flights(flights, bi.BiFilter(**filters)).first()[0]


def test_filters(flights):
    assert total(flights) == 5
    assert total(flights, date_from=DAYS[1], date_to=DAYS[2]) == 2
    assert total(flights, date_from=DAYS[1]) == 3
    assert total(flights, date_to=DAYS[1]) == 2
    assert total(flights, years=[2026]) == 1
    assert total(flights, months=[1, 2], years=[2025]) == 3
    assert total(flights, months=[12]) == 0


def test_months(flights):
    assert {tuple(r) for r in bi.passengers_by_month(flights).collect()} == {(1, 480), (2, 480), (None, 240)}
    assert {tuple(r) for r in bi.flights_by_month(flights).collect()} == {(1, 2, 1), (2, 2, 1), (None, 1, 1)}


def options(flights, column, **filters):
    return {r[0]: r[1] for r in bi.filter_options(flights, column, bi.BiFilter(**filters)).collect()}


def test_options_count_rows_that_pass_the_other_filters(flights):
    assert options(flights, bi.MONTH, years=[2025]) == {1: 1, 2: 2, None: 0}
    assert options(flights, bi.MONTH, months=[1]) == {1: 2, 2: 2, None: 1}
    assert options(flights, bi.YEAR, months=[1], date_to=DAYS[1]) == {2025: 1, 2026: 0, None: 0}
    assert options(flights, bi.DATE, years=[2025], date_from=DAYS[3]) == {
        DAYS[0]: 1, DAYS[1]: 1, DAYS[2]: 1, DAYS[3]: 0, None: 0,
    }


@pytest.mark.parametrize(
    "filters",
    [bi.NO_FILTER, bi.BiFilter(date_from=DAYS[1], years=[2025], months=[2]), bi.BiFilter(months=[12])],
)
def test_summary_gives_the_same_dashboard(flights, filters):
    doubled = flights.unionByName(flights).unionByName(flights.limit(1))
    full = bi.dashboard(doubled, filters)
    short = bi.dashboard(bi.summarise(doubled), filters, summary=True)
    assert len(full) == 6
    for name, widget in full.items():
        assert rows(widget) == rows(short[name]), name
