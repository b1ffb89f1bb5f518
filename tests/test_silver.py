from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal as D

import pytest

from fixture_rows import ROWS, fixture_layers
from tierline.catalogue import SILVER_LINEAGE, TABLES


@pytest.fixture(scope="module")
def layers(spark):
    return fixture_layers(spark)


def by_key(layers, table):
    key = TABLES[table].key
    return {"+".join(str(r[k]) for k in key): r.asDict() for r in layers.silver(table).collect()}


@pytest.mark.parametrize("table", list(TABLES))
def test_rows_are_kept_and_columns_declared(layers, table):
    df = layers.silver(table)
    assert df.columns == [*TABLES[table].silver_columns(), *SILVER_LINEAGE]
    rows = df.collect()
    assert len(rows) == len(ROWS[table])
    flags = [c for c, kind in df.dtypes if kind == "boolean" and c != "active"]
    assert all(r[c] is not None for r in rows for c in flags)


def test_students(layers):
    rows = by_key(layers, "students")
    one = rows["S1"]
    assert (one["first_name"], one["last_name"], one["email"], one["country"]) == ("Ana Maria", "O'neil", "a@x.com", "MX")
    assert one["birth_date"] == date(2000, 1, 1) and one["enrolled_at"] == datetime(2020, 3, 1, 10)
    assert [rows[k]["is_temporally_valid"] for k in ("S1", "S2", "S3")] == [True, False, False]


def test_semesters_accept_equal_dates(layers):
    rows = by_key(layers, "semesters")
    assert rows["T1"]["is_temporally_valid"] and not rows["T2"]["is_temporally_valid"]


def test_unconvertible_text_is_null(layers):
    assert by_key(layers, "courses")["C2"]["credits"] is None
    assert by_key(layers, "products")["R3"]["monthly_price"] is None
    assert by_key(layers, "products")["R3"]["active"] is None


def test_repeated_combinations_include_null_keys(layers):
    rows = by_key(layers, "enrollments")
    assert [rows[f"E{i}"]["is_repeated_combination"] for i in range(1, 6)] == [True, True, False, True, True]


def test_grades(layers):
    rows = by_key(layers, "grades")
    assert [rows[f"G{i}"]["is_score_valid"] for i in range(1, 8)] == [True, True, True, False, True, False, True]
    assert [rows[f"G{i}"]["is_weight_valid"] for i in range(1, 8)] == [True, True, True, True, False, True, False]
    assert rows["G1"]["total_weight"] == D("1.0000") and rows["G3"]["total_weight"] == D("0.9999")
    # A missing weight spoils the sum; a NULL enrollment is a group like any other.
    assert [rows[f"G{i}"]["is_weight_sum_one"] for i in range(1, 8)] == [True, True, False, False, False, True, False]


def test_links(layers):
    assert [r["is_student_linked"] for r in by_key(layers, "customers").values()].count(True) == 1
    subscriptions = by_key(layers, "subscriptions")
    assert [subscriptions[k]["is_temporally_valid"] for k in ("U1", "U2", "U3")] == [True, False, False]
    assert [subscriptions[k]["is_customer_linked"] for k in ("U1", "U2", "U3")] == [True, True, False]
    assert [subscriptions[k]["is_product_linked"] for k in ("U1", "U2", "U3")] == [True, True, False]


def test_invoice_items_tolerance(layers):
    rows = by_key(layers, "invoice_items")
    assert [rows[f"L{i}"]["is_line_total_valid"] for i in range(1, 5)] == [True, False, False, True]
    assert [rows[f"L{i}"]["is_quantity_valid"] for i in range(1, 5)] == [True, True, False, False]
    assert rows["L1"]["calculated_line_total"] == D("100.00")


def test_payments_use_the_invoice_date(layers):
    rows = by_key(layers, "payments")
    assert [rows[f"Y{i}"]["is_temporally_valid"] for i in range(1, 7)] == [True, False, True, False, True, False]
    assert [rows[f"Y{i}"]["is_method_valid"] for i in range(1, 7)] == [True, True, True, False, True, True]
    assert not rows["Y5"]["is_amount_valid"] and not rows["Y6"]["is_invoice_linked"]


def test_crm_flags(layers):
    contacts = by_key(layers, "contacts")
    assert [contacts[k]["is_email_present"] for k in ("N1", "N2", "N3")] == [True, False, False]
    deals = by_key(layers, "opportunities")
    assert [deals[k]["is_temporally_valid"] for k in ("O1", "O2", "O3")] == [True, False, False]
    assert [deals[k]["is_amount_valid"] for k in ("O1", "O2", "O3")] == [True, False, True]
    relations = by_key(layers, "opportunity_contacts")
    assert [r["is_same_account"] for r in relations.values()].count(True) == 1
    assert relations["O1+N1"]["is_same_account"] and not relations["O3+N3"]["is_same_account"]
    activities = by_key(layers, "activities")
    assert activities["V2"]["opportunity_id"] is None and not activities["V4"]["has_any_reference"]
    assert activities["V7"]["has_contact_id"] and not activities["V7"]["is_contact_linked"]
