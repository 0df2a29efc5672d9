"""Dictionaries of the two blocks as tables: names of columns and rows, signals of tables, mapping rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.rules import RULES

# What headers call the fields.
COLUMN_ALIASES = {
    "C": {
        "gross_opening": ("opening", "gross opening", "opening as on", "opening value", "value at beginning"),
        "gross_addition_reval": ("revaluation", "reval", "addition due to reval", "addition reval"),
        "gross_addition_actual": ("actual addition", "addition", "actual", "additions during"),
        "gross_deduction": ("deduction", "deductions", "sold", "discarded", "adjustment deduction"),
        "gross_closing": ("closing", "gross closing", "closing as on", "closing value", "value at end"),
        "dep_up_to_beginning": ("dep opening", "depreciation opening", "dep upto beginning", "accum dep opening", "depreciation up to beginning", "up to year beginning"),
        "dep_provided_during_year": ("dep during year", "depreciation during year", "provided during", "dep for the year", "depreciation for year"),
        "dep_adjustment": ("dep adj", "dep on sold", "dep on discarded", "depreciation adjustment", "adj for sold"),
        "dep_up_to_end": ("dep closing", "dep upto end", "depreciation closing", "dep up to end", "accum dep closing", "up to year end", "upto end of year", "total depreciation", "accumulated depreciation"),
        "net_opening": ("net opening", "wdv opening", "net value opening", "wdv at beginning", "written down value opening", "book value opening"),
        "net_closing": ("net closing", "wdv closing", "net value closing", "wdv at end", "net block", "written down value closing", "book value closing", "wdv"),
    },
    "D": {
        "opening_rs": ("opening", "opening balance", "opening rs", "opening (rs)", "as at beginning", "previous year", "as at 01/04"),
        "closing_rs": ("closing", "closing balance", "closing rs", "closing (rs)", "as at end", "current year", "as at 31/03"),
    },
}
# What statements call the rows, by number.
ROW_ALIASES = {
    "C": {
        1: ("land", "freehold land", "leasehold land"),
        2: ("building", "buildings", "factory building", "office building"),
        3: ("plant and machinery", "plant & machinery", "plant & mach", "p & m", "p&m", "machinery", "plant"),
        4: ("transport equipment", "transport", "vehicles", "vehicle", "motor vehicle", "motor vehicles"),
        5: ("computer equipment", "computer & software", "computers", "it equipment", "computer equipment & software", "computer equipment and software"),
        6: ("pollution control", "pollution control equipment", "etp", "effluent treatment"),
        7: ("others", "other assets", "miscellaneous", "misc assets", "other fixed assets", "furniture", "furniture & fixtures", "office equipment"),
        8: ("sub total", "sub-total", "subtotal", "sub total (2 to 7)", "sub-total(2 to 7)"),
        9: ("capital work in progress", "cwip", "capital wip", "work in progress", "wip"),
        10: ("total", "grand total", "total (1+8+9)", "total(1+8+9)", "total fixed assets"),
    },
    "D": {
        1: ("raw materials", "raw material", "raw materials & components", "packing materials", "raw materials & components and packing materials", "raw mat"),
        2: ("fuels", "fuel", "lubricants", "fuels & lubricants", "fuel & lubricants"),
        3: ("spares", "stores", "spare parts", "spares stores", "spares, stores & others", "spares and stores"),
        4: ("sub total", "sub-total", "subtotal", "sub total (1 to 3)", "sub-total(1 to 3)"),
        5: ("semi finished", "semi-finished", "work in progress", "wip", "semi finished goods", "semi-finished goods/work in progress"),
        6: ("finished goods", "finished stock", "finished products"),
        7: ("total inventory", "total stock", "inventory total", "total inventory(4 to 6)"),
        8: ("cash", "cash in hand", "cash at bank", "cash and bank", "cash in hand & at bank", "cash & bank balance"),
        9: ("sundry debtors", "debtors", "trade debtors", "accounts receivable", "receivables"),
        10: ("other current assets", "other assets", "miscellaneous current assets", "prepaid", "advances", "loans and advances"),
        11: ("total current assets", "current assets total", "total current assets(7 to 10)"),
        12: ("sundry creditors", "creditors", "trade creditors", "accounts payable", "payables"),
        13: ("overdraft", "cash credit", "od", "cc", "short term loan", "bank overdraft", "over draft", "over draft cash credit", "other short term loan"),
        14: ("other current liabilities", "other liabilities", "provisions", "outstanding expenses"),
        15: ("total current liabilities", "current liabilities total", "total current liabilities(12 to 14)"),
        16: ("working capital", "net working capital", "working capital(11-15)"),
        17: ("outstanding loans", "loans outstanding", "term loans", "long term loans", "outstanding loans excluding interest", "outstanding loans(excluding interest"),
    },
}
# Phrases that tell a table's block.
SIGNALS = {
    "C": ("fixed assets", "gross block", "net block", "depreciation", "land", "building", "plant", "machinery", "capital work", "cwip", "schedule of fixed assets", "fixed asset schedule"),
    "D": ("working capital", "current assets", "current liabilities", "inventory", "sundry debtors", "sundry creditors", "cash in hand", "raw material", "finished goods", "debtors", "creditors", "overdraft"),
}
# Phrases that tell a profile, and its rules: profile, row, side, component, sign (no component: the row is zero).
PROFILE_PHRASES = {"lacs_corporate": ("amounts in lacs", "amounts m lacs"), "rupees_schedule": ("schedule 8", "schedule 9", "schedule 10")}
RULE_ROWS = (
    ("lacs_corporate", 1, "opening", "note_8.raw_materials", 1),
    ("lacs_corporate", 1, "closing", "note_8.raw_materials", 1),
    ("lacs_corporate", 2, "opening", None, 0),
    ("lacs_corporate", 2, "closing", None, 0),
    ("lacs_corporate", 3, "opening", "note_8.stores_spares", 1),
    ("lacs_corporate", 3, "closing", "note_8.stores_spares", 1),
    ("lacs_corporate", 5, "opening", "note_8.wip", 1),
    ("lacs_corporate", 5, "closing", "note_8.wip", 1),
    ("lacs_corporate", 6, "opening", "note_8.finished", 1),
    ("lacs_corporate", 6, "closing", "note_8.finished", 1),
    ("lacs_corporate", 8, "opening", "note_10.cash_and_bank", 1),
    ("lacs_corporate", 8, "closing", "note_10.cash_and_bank", 1),
    ("lacs_corporate", 9, "opening", "face.trade_receivables", 1),
    ("lacs_corporate", 9, "closing", "face.trade_receivables", 1),
    ("lacs_corporate", 10, "opening", "face.other_current_assets", 1),
    ("lacs_corporate", 10, "closing", "face.other_current_assets", 1),
    ("lacs_corporate", 12, "opening", "note_17.micro_creditors", 1),
    ("lacs_corporate", 12, "opening", "note_17.other_creditors", 1),
    ("lacs_corporate", 12, "closing", "note_17.other_creditors", 1),
    ("lacs_corporate", 12, "closing", "note_18.salary_wages_payable", 1),
    ("lacs_corporate", 13, "opening", "note_16.cash_credit", 1),
    ("lacs_corporate", 13, "closing", "note_16.cash_credit", 1),
    ("lacs_corporate", 14, "opening", "note_20.total", 1),
    ("lacs_corporate", 14, "opening", "note_18.salary_wages_payable", 1),
    ("lacs_corporate", 14, "opening", "note_16.current_maturities", -1),
    ("lacs_corporate", 14, "closing", "note_20.total", 1),
    ("lacs_corporate", 14, "closing", "note_18.salary_wages_payable", 1),
    ("lacs_corporate", 14, "closing", "note_16.current_maturities", 1),
    ("lacs_corporate", 14, "closing", "note_16.cash_credit", -1),
    ("lacs_corporate", 14, "closing", "note_20.advance_from_customers", -1),
    ("lacs_corporate", 17, "opening", "face.borrowings_non_current", 1),
    ("lacs_corporate", 17, "closing", "face.borrowings_non_current", 1),
    ("rupees_schedule", 1, "opening", "schedule_6.stock_in_hand", 1),
    ("rupees_schedule", 1, "closing", "schedule_6.stock_in_hand", 1),
    ("rupees_schedule", 2, "opening", None, 0),
    ("rupees_schedule", 2, "closing", None, 0),
    ("rupees_schedule", 3, "opening", None, 0),
    ("rupees_schedule", 3, "closing", None, 0),
    ("rupees_schedule", 5, "opening", "schedule_6.wip", 1),
    ("rupees_schedule", 5, "closing", "schedule_6.wip", 1),
    ("rupees_schedule", 6, "opening", "schedule_6.finished", 1),
    ("rupees_schedule", 6, "closing", "schedule_6.finished", 1),
    ("rupees_schedule", 8, "opening", "schedule_8.total", 1),
    ("rupees_schedule", 8, "closing", "schedule_8.total", 1),
    ("rupees_schedule", 9, "opening", "face.trade_receivables", 1),
    ("rupees_schedule", 9, "closing", "face.trade_receivables", 1),
    ("rupees_schedule", 10, "opening", "face.loans_and_advances", 1),
    ("rupees_schedule", 10, "closing", "face.loans_and_advances", 1),
    ("rupees_schedule", 12, "opening", "schedule_10.creditors_raw_material", 1),
    ("rupees_schedule", 12, "opening", "schedule_10.creditors_expenses", 1),
    ("rupees_schedule", 12, "closing", "schedule_10.creditors_raw_material", 1),
    ("rupees_schedule", 12, "closing", "schedule_10.creditors_expenses", 1),
    ("rupees_schedule", 13, "opening", "schedule_3.cash_credit", 1),
    ("rupees_schedule", 13, "closing", "schedule_3.cash_credit", 1),
    ("rupees_schedule", 14, "opening", "schedule_10.other_liabilities_total", 1),
    ("rupees_schedule", 14, "closing", "schedule_10.other_liabilities_total", 1),
    ("rupees_schedule", 17, "opening", "schedule_3.unsecured_loan", 1),
    ("rupees_schedule", 17, "closing", "schedule_3.unsecured_loan", 1),
)
#: Which profile comes first where both yield as many rows.
PROFILE_ORDER = {"lacs_corporate": 0, "rupees_schedule": 1}

ALIASES = "canonical string, alias string, ordinal int"


def column_aliases(spark: SparkSession, block: str) -> DataFrame:
    """(canonical, alias, ordinal) of a block's fields, for ``map_headers``."""
    rows = [(field, alias) for field, names in COLUMN_ALIASES[block].items() for alias in names]
    return spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], ALIASES)


def row_aliases(spark: SparkSession, block: str) -> DataFrame:
    """(canonical, alias, ordinal) of a block's rows by their labels, for ``best_match``."""
    from . import schema

    labels = schema.C_LABELS if block == "C" else schema.D_LABELS
    rows = [(labels[sl - 1], alias) for sl, names in ROW_ALIASES[block].items() for alias in names]
    return spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], ALIASES)


def signals(spark: SparkSession) -> DataFrame:
    """(block, phrase), for ``classify_tables``."""
    return spark.createDataFrame([(b, p) for b, phrases in SIGNALS.items() for p in phrases], "block string, phrase string")


def mapping_rules(spark: SparkSession) -> DataFrame:
    """The rules for ``rules.evaluate`` and ``apply_mapping``."""
    return spark.createDataFrame(RULE_ROWS, RULES)
