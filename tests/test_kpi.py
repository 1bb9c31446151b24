"""KPI-feed scan and cleaning on hand-written fixture files (FIXTURES.md §1)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shopcube.operators.kpi import HEADER, clean_kpi_feed, reconcile_kpis, rollup_kpis
from shopcube.sources.kpi_csv import read_kpi_csv

HEAD = ",".join(HEADER)

# day-first file: period row, day rows (one with day > 12), a percent with
# trailing zeros, integers where other rows have decimals
FILE1 = "\n".join([
    HEAD,
    "2024-03-01~2024-03-31,3000.5,250,12,13,600,20,4.80%,250.04,12.00,40,50,6,5,230.81,1.54,100,0",
    "02/03/2024,1000.25,100,5,5,200,8,5.00%,200.05,10.00,15,20,2,2,200.05,1.60,100,0",
    "14/03/2024,1500,90,5,6,250,9,5.56%,300,16.67,15,20,3,2,250,1.50,0,0",
    "20/03/2024,500.25,80,2,2,150,3,2.50%,250.13,6.25,10,10,1,1,250.13,1.50,0,0",
])
# ISO file: period row, dash row, dash cells, 10.00% percent, zero visitors
FILE2 = "\n".join([
    HEAD,
    "2025-02-01~2025-02-28,700.00,40,4,4,90,6,10.00%,175.00,17.50,9,12,-,-,175.00,1.50,0.00,25.00",
    "-,-,-,-,-,-,-,-,-,-,-,-,-,-,-,-,-,-",
    "2025-02-03,400.00,20,2,2,50,4,10.00%,200.00,20.00,5,8,-,-,200.00,2.00,0.00,25.00",
    "2025-02-04,300.00,20,2,2,40,2,10.00%,150.00,15.00,4,4,-,-,150.00,1.00,0.00,0.00",
    "2025-02-05,0.00,0,0,0,0,0,-,-,-,0,0,-,-,-,-,0.00,0.00",
])
# bad rows: short, long, unknown date, bad number
FILE3 = "\n".join([
    HEAD,
    "2025-02-06,1.00,1,1",
    "2025-02-07,1.00,1,1,1,1,1,100.00%,1.00,1.00,1,1,1,1,1.00,1.00,0.00,0.00,EXTRA",
    "31/31/2025,1.00,1,1,1,1,1,100.00%,1.00,1.00,1,1,1,1,1.00,1.00,0.00,0.00",
    "2025-02-08,abc,1,1,1,1,1,100.00%,1.00,1.00,1,1,1,1,1.00,1.00,0.00,0.00",
])


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("kpi")
    for i, body in enumerate([FILE1, FILE2, FILE3], 1):
        (d / f"export{i}.csv").write_text(body + "\n", encoding="utf-8")
    raw = read_kpi_csv(spark, str(d), "Lazada")
    return clean_kpi_feed(raw)


def test_split_counts(feed):
    assert feed.daily.count() == 6
    assert feed.period.count() == 2
    reasons = {r["reason"]: r["n"] for r in
               feed.quarantine.groupBy("reason").agg(F.count("*").alias("n")).collect()}
    assert reasons == {"malformed_row": 2, "bad_date": 1, "bad_number": 1}


def test_day_first_and_iso_dates(feed):
    dates = {str(r["date"]) for r in feed.daily.select("date").collect()}
    assert {"2024-03-02", "2024-03-14", "2024-03-20", "2025-02-03"} <= dates
    assert "2024-02-03" not in dates  # never month-first


def test_percent_dash_and_numbers(feed):
    rows = {str(r["date"]): r for r in feed.daily.collect()}
    assert rows["2024-03-02"]["conversion_rate"] == Decimal("0.0500")
    assert rows["2025-02-03"]["conversion_rate"] == Decimal("0.1000")
    assert rows["2025-02-03"]["wishlists"] is None          # dash cell -> NULL
    assert rows["2025-02-03"]["buyers"] == 2                # other cells intact
    assert rows["2024-03-14"]["total_sales_value"] == Decimal("1500.00")
    zero = rows["2025-02-05"]
    assert zero["visitors"] == 0 and zero["conversion_rate"] is None


def test_period_row(feed):
    p = {str(r["period_start"]): r for r in feed.period.collect()}
    assert str(p["2024-03-01"]["period_end"]) == "2024-03-31"
    assert p["2024-03-01"]["conversion_rate"] == Decimal("0.0480")


def test_reconcile_additive_columns(feed):
    r = {str(x["period_start"]): x for x in reconcile_kpis(feed.daily, feed.period).collect()}
    assert r["2024-03-01"]["reconciled"] and r["2025-02-01"]["reconciled"]
    assert r["2024-03-01"]["days"] == 3


def test_ratio_formulas_within_tolerance(feed):
    for r in feed.daily.collect():
        if r["visitors"]:
            assert abs(float(r["conversion_rate"]) - r["buyers"] / r["visitors"]) <= 0.015
        if r["total_orders"]:
            aov = float(r["total_sales_value"]) / r["total_orders"]
            assert abs(float(r["average_order_value"]) - aov) <= 0.015


def test_rollup_sums_additive_never_people(feed):
    roll = {str(r["period_start"]): r for r in rollup_kpis(feed.daily).collect()}
    m = roll["2024-03-01"]
    assert m["total_orders"] == 13 and m["total_sales_value"] == Decimal("3000.50")
    assert "visitors" not in m.asDict()


def test_wrong_header_fails(spark, tmp_path):
    bad = tmp_path / "bad.csv"
    bad.write_text(",".join(reversed(HEADER)) + "\n" + FILE1.splitlines()[2] + "\n")
    with pytest.raises(Exception):
        read_kpi_csv(spark, str(bad), "Lazada").collect()


def test_unknown_platform(spark, tmp_path):
    with pytest.raises(ValueError):
        read_kpi_csv(spark, str(tmp_path), "Nowhere")


def test_cell_parsing_roundtrip_property(spark):
    """Random day rows, written as exports write them (dd/MM/yyyy or ISO dates,
    integer or 2-decimal money, percent with '%', '-' for missing), parse back
    exactly.  One DataFrame per hypothesis batch keeps Spark calls few."""
    import datetime as dt

    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    from shopcube.operators.kpi import COLUMNS

    money = st.integers(min_value=0, max_value=10 ** 9)          # cents
    count = st.integers(min_value=0, max_value=10 ** 6)
    pct = st.integers(min_value=0, max_value=10000)              # hundredths of a percent
    day = st.dates(min_value=dt.date(2000, 1, 1), max_value=dt.date(2030, 12, 31))
    row = st.tuples(day, st.booleans(), money, st.booleans(), count, pct, st.booleans())

    def fmt_money(c, as_int):
        return str(c // 100) if as_int and c % 100 == 0 else f"{c // 100}.{c % 100:02d}"

    @settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(row, min_size=1, max_size=40, unique_by=lambda r: r[0]))
    def check(rows):
        raw, exp = [], {}
        for d, iso, rev, as_int, n, p, dash in rows:
            cells = {h: "0" for h, _, _ in COLUMNS}
            cells["Date"] = d.isoformat() if iso else d.strftime("%d/%m/%Y")
            cells["Revenue"] = fmt_money(rev, as_int)
            cells["Visitors"] = str(n)
            cells["Conversion Rate"] = f"{p // 100}.{p % 100:02d}%"
            cells["Wishlists"] = "-" if dash else str(n)
            raw.append(tuple(cells[h] for h in HEADER) + ("x", "f", None))
            exp[d] = (Decimal(rev) / 100, n, Decimal(p) / 10000, None if dash else n)
        schema = ", ".join(f"`{h}` string" for h in HEADER) + \
            ", platform string, source_file string, _corrupt_record string"
        got = clean_kpi_feed(spark.createDataFrame(raw, schema)).daily.collect()
        assert len(got) == len(rows)
        for r in got:
            assert (r["total_sales_value"], r["visitors"], r["conversion_rate"], r["wishlists"]) \
                == exp[r["date"]]

    check()


def _clean(spark, rows):
    raw = []
    for cells, corrupt in rows:
        raw.append(tuple(cells.get(h) for h in HEADER) + ("x", "f", corrupt))
    return clean_kpi_feed(spark.createDataFrame(raw, ", ".join(f"`{h}` string" for h in HEADER)
                                                + ", platform string, source_file string, _corrupt_record string"))


def test_large_amounts_and_counts_are_kept(spark):
    c = _clean(spark, [({"Date": "2024-05-01", "Revenue": "12345678901.00", "Visitors": "9999999999"}, None)])
    assert c.quarantine.count() == 0
    r = c.daily.collect()[0]
    assert (r["total_sales_value"], r["visitors"]) == (Decimal("12345678901.00"), 9999999999)
    assert rollup_kpis(c.daily).collect()[0]["total_sales_value"] == Decimal("12345678901.00")


def test_corrupt_rows_come_before_dash_rows_and_days_keep_to_their_period(spark):
    c = _clean(spark, [({"Date": "2024-05-01~2024-05-31", "Revenue": "5"}, None), ({}, "short,row"), ({"Date": "-"}, None),
                       ({"Date": "2024-05-31", "Revenue": "1"}, None), ({"Date": "2024-06-01", "Revenue": "1"}, None)])
    assert sorted(r["reason"] for r in c.quarantine.collect()) == ["malformed_row", "out_of_period"]
    assert [str(r["date"]) for r in c.daily.collect()] == ["2024-05-31"]


def test_equal_period_rows_and_repeated_days_reconcile(spark):
    period = ({"Date": "2024-05-01~2024-05-31", "Revenue": "3", "Orders": "1"}, None)
    c = _clean(spark, [period, period, ({"Date": "2024-05-02", "Revenue": "1", "Orders": "1"}, None),
                       ({"Date": "2024-05-02", "Revenue": "2", "Orders": "0"}, None)])
    r = reconcile_kpis(c.daily, c.period).collect()
    assert len(r) == 1 and r[0]["reconciled"] and r[0]["days"] == 1
