"""Schedules and notes read by specifications."""

import pytest
from pyspark.sql import functions as F

from tallyforge.operators import schedules as s


def page(spark, *texts):
    return spark.createDataFrame([(1, k, t) for k, t in enumerate(texts, 1)], "doc_id bigint, page_no int, text string")


def pairs(df):
    return {r.key: (r.opening, r.closing) for r in df.collect()}


RUPEES = """SCHEDULE 8 CASH & BANK
Cash at hand 50,000 40,000
Balances at schedule banks 20,00,000 10,00,000
Sum of it 20,50,000 10,40,000
SCHEDULE 9 LOANS & ADVANCES
Subsidy receivable 9,00,00,000 8,50,00,000
End 9,50,00,000 9,10,00,000
SCHEDULE 10 CURRENT LIABILITIES
For raw material 5,00,000 4,00,000
Advance from customers 1,00,000 2,00,000
Statutory dues 50,000 60,000
Total 99,00,000 98,00,000
SCHEDULE 3
Cash Credit 25,00,000 20,00,000
From others 40,00,000 35,00,000"""


def test_rupee_schedules(spark):
    got = pairs(s.extract_components(page(spark, RUPEES)))
    assert got == {
        "schedule_8.cash_on_hand": (40000, 50000), "schedule_8.bank": (1000000, 2000000), "schedule_8.total": (1040000, 2050000),
        "schedule_9.subsidy_receivable": (85000000, 90000000), "schedule_9.total": (91000000, 95000000),
        "schedule_10.creditors_raw_material": (400000, 500000), "schedule_10.advance_from_customers": (200000, 100000),
        "schedule_10.statutory_dues": (60000, 50000), "schedule_3.cash_credit": (2000000, 2500000), "schedule_3.unsecured_loan": (3500000, 4000000),
    }
    assert [(r.opening, r.closing) for r in s.other_liabilities(page(spark, RUPEES)).collect()] == [(260000, 150000)]


def test_lakh_notes_and_pages(spark):
    text = "Amounts in Lacs\nBalance sheet as at\nTrade receivables 9 1,234.50 1,100.25\nCash credit 2,500.00 2,000.00\n20 Other current liabilities\nTotal 400.00 350.00\nSalary & wages payable 300.00 250.00"
    got = pairs(s.all_components(page(spark, text)))
    assert got["face.trade_receivables"] == pytest.approx((1100.25e5, 1234.50e5))
    assert got["note_16.cash_credit"] == pytest.approx((2000e5, 2500e5))
    assert got["note_20.total"] == pytest.approx((350e5, 400e5))
    assert got["note_18.salary_wages_payable"] == pytest.approx((250e5, 300e5))


def test_asset_letters(spark):
    text = 'Block "D" Plant 1,000 1,000 100 50 150 900 880\nBlock "E" Office 10 10 1 1 2 9 8\nBlock "G" Computer 20 20 2 2 4 17 18\nBlock "A" few 1 2'
    got = {r.sl_no: r for r in s.asset_letter_rows(page(spark, text)).collect()}
    assert set(got) == {3, 5}
    assert (got[3].gross_opening, got[3].net_closing, got[3].net_opening, got[3].gross_closing, got[3].gross_addition_actual) == (1000, 900, 880, 1050, 50)
    assert (got[5].gross_opening, got[5].net_closing, got[5].dep_up_to_end) == (30, 26, 6)


def grid(label, start):
    return label + "\t" + "\t".join(f"{start + k},00,000" for k in range(8))


def test_asset_grid(spark):
    text = "\n".join(("Property, Plant schedule 5", grid("Balance 1st April 2023", 10), "NET BLOCK", grid("Balance March 2024", 12), "x accumulated charged", grid("accumulated dep charged", 1), grid("Balance 1st Apr 2023", 20)))
    got = {r.sl_no: r for r in s.asset_grid_rows(page(spark, text)).collect()}
    assert set(got) == {2, 3, 4, 5, 7}
    assert got[2].net_opening == 2_100_000 and got[2].net_closing == 2_500_000 and got[2].dep_provided_during_year == 300_000
    assert got[7].net_opening == 2_600_000 and got[3].dep_up_to_beginning == 2_300_000


def test_subtotals_and_totals(spark):
    line = grid("Balance 1st Apr 2023", 500) + "\t37,54,93,027\t37,54,93,027"
    got = s.gross_subtotals(page(spark, line + "\n" + line.replace("1st Apr 2023", "March 2024").replace("37,54", "38,54"))).first()
    assert (got.opening, got.closing) == (375493027, 385493027)
    assert [(r.opening, r.closing) for r in s.total_nets(page(spark, "Total (a) 1 9,00,00,000 10,47,84,801")).collect()] == [(104784801, 90000000)]
    assert [(r.opening, r.closing) for r in s.face_net(page(spark, "Property, plant and equipment 5 1,00,00,000 90,00,000")).collect()] == [(9000000, 10000000)]


def test_note_rows_and_progress(spark):
    text = "Amounts in Lacs Property, Plant note\nLand 100.00 100.00\nBuilding 18.89 15.51 7.00 3.38\nComputers\n12.00 10.00\n5: Capital work in progress\nTotal 900.00 900.00 1,200.00"
    got = {r.sl_no: r for r in s.asset_note_rows(page(spark, text)).collect()}
    assert set(got) == {1, 2, 5}
    assert got[2].net_closing == pytest.approx(18.89e5) and got[2].dep_provided_during_year == pytest.approx(3.38e5) and got[5].net_opening == pytest.approx(10e5)
    assert [(r.opening, r.closing) for r in s.work_in_progress(page(spark, text)).collect()] == [(pytest.approx(900e5), pytest.approx(1200e5))]


def test_stock_cash_and_form_rows(spark):
    stock = "Stock in hand 5,00,000 4,00,000\nStock in hand 3,000 2,000\nStock in hand 70,000 60,000"
    assert {r.sl_no: (r.opening, r.closing) for r in s.inventory_note(page(spark, stock)).collect()} == {1: (400000, 500000), 5: (2000, 3000), 6: (60000, 70000)}
    cash = "Cash and cash equivalents 10A 20.00 10.00 Bank balances other 10B 5.00 4.00"
    assert [(r.opening, r.closing) for r in s.cash_from_face(page(spark, cash)).collect()] == [(pytest.approx(14e5), pytest.approx(25e5))]
    form = "Block D: Working Capital\n1 Raw Materials 1,000 2,000\n8 Cash 5 -6\n13 Over draft\ninstitutions 7 8\n99 none 1 2\n1 Raw Materials 1,100 2,200"
    assert {r.sl_no: (r.opening_rs, r.closing_rs) for r in s.form_rows_d(page(spark, form)).collect()} == {1: (1100, 2200), 8: (5, -6), 13: (7, 8)}
    form = "Block C: Fixed Assets\n2 Building 10 1 2 3 10 4\n5 0 9 6 1\n3 Plant and Machinery 100 120 0 70 60\n10 Total(1+8+9) 500 40 30 20"
    got = {r.sl_no: r for r in s.form_rows_c(page(spark, form)).collect()}
    assert (got[2].gross_opening, got[2].gross_closing, got[2].net_opening, got[2].net_closing) == (10, 10, 6, 1)
    assert (got[3].gross_opening, got[3].gross_closing, got[3].net_opening, got[3].dep_up_to_end, got[3].dep_up_to_beginning) == (100, 120, 70, 60, 30)
    assert (got[10].net_opening, got[10].net_closing) == (30, 20)


def test_pairs_sums_and_cascade(spark):
    df = spark.createDataFrame([([10.0, 8.0, 10.0],), ([5000.0, 20.0, 18.0],), ([1.0],)], "v array<double>")
    assert [(r.x.opening, r.x.closing) for r in df.select(s.net_pair(F.col("v")).alias("x")).collect()] == [(8, 10), (20, 18), (0, 0)]
    df = spark.createDataFrame([([3.0, 45.0, 5.0, 25.0, 12.0],)], "v array<double>")
    assert df.select(s.split_decimal_sum(F.col("v")).alias("x")).first().x == pytest.approx(3 + 5.25 + 12)
    a, b = (spark.createDataFrame(rows, "doc_id int, sl_no int") for rows in ([(1, 1)], [(1, 2), (2, 2)]))
    assert {tuple(r) for r in s.cascade(a, b).collect()} == {(1, 1), (2, 2)}
