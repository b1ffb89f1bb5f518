"""Hand-made bronze rows with the edge cases of each table; columns left out are NULL."""

from __future__ import annotations

from datetime import datetime, timezone

from tierline.catalogue import TABLES
from tierline.plans.layers import Layers
from tierline.sources.csv import with_lineage

ROWS: dict[str, list[dict]] = {
    "students": [
        {"student_id": " S1 ", "first_name": "ana MARIA", "last_name": "o'neil", "email": " A@X.COM",
         "birth_date": "2000-01-01", "enrolled_at": "2020-03-01 10:00:00", "country": " mx "},
        {"student_id": "S2", "first_name": "Bo", "birth_date": "2020-03-01", "enrolled_at": "2020-03-01 10:00:00"},
        {"student_id": "S3", "first_name": None, "last_name": "solo", "birth_date": "bad", "enrolled_at": None},
    ],
    "professors": [{"professor_id": "P1", "first_name": "pi", "last_name": "rho", "department": "cs"}],
    "courses": [
        {"course_id": "C1", "code": "c-1", "name": "One", "credits": "3", "professor_id": "P1"},
        {"course_id": "C2", "code": "c-2", "name": "Two", "credits": "x", "professor_id": "P9"},
    ],
    "semesters": [
        {"semester_id": "T1", "year": "2020", "half": "1", "start_date": "2020-01-01", "end_date": "2020-01-01"},
        {"semester_id": "T2", "year": "2021", "half": "3", "start_date": "2021-02-01", "end_date": "2021-01-01"},
    ],
    "enrollments": [
        {"enrollment_id": "E1", "status": "Completed", "student_id": "S1", "course_id": "C1", "semester_id": "T1"},
        {"enrollment_id": "E2", "status": "failed", "student_id": "S1", "course_id": "C1", "semester_id": "T1"},
        {"enrollment_id": "E3", "status": "dropped", "student_id": "S1", "course_id": "C1", "semester_id": "T2"},
        {"enrollment_id": "E4", "status": "active", "student_id": None, "course_id": "C1", "semester_id": None},
        {"enrollment_id": "E5", "status": "odd", "student_id": None, "course_id": "C1", "semester_id": None},
    ],
    "grades": [
        {"grade_id": "G1", "score": "80", "weight": "0.5", "enrollment_id": "E1"},
        {"grade_id": "G2", "score": "91", "weight": "0.5", "enrollment_id": "E1"},
        {"grade_id": "G3", "score": "0", "weight": "0.9999", "enrollment_id": "E2"},
        {"grade_id": "G4", "score": "101", "weight": "0.5", "enrollment_id": "E3"},
        {"grade_id": "G5", "score": "100", "weight": None, "enrollment_id": "E3"},
        {"grade_id": "G6", "score": "-1", "weight": "1", "enrollment_id": None},
        {"grade_id": "G7", "score": "50", "weight": "1.0001", "enrollment_id": "E4"},
    ],
    "customers": [
        {"customer_id": "K1", "external_ref": " S1", "first_name": "x", "last_name": "y"},
        {"customer_id": "K2", "external_ref": None},
        {"customer_id": "K3", "external_ref": " "},
        {"customer_id": "K4", "external_ref": "S9"},
    ],
    "products": [
        {"product_id": "R1", "sku": "a", "monthly_price": "10", "active": "True"},
        {"product_id": "R2", "sku": "A", "monthly_price": "-1", "active": "false"},
        {"product_id": "R3", "sku": None, "monthly_price": "x", "active": "maybe"},
    ],
    "subscriptions": [
        {"subscription_id": "U1", "status": "active", "start_date": "2020-01-01", "end_date": "2020-01-01",
         "customer_id": "K1", "product_id": "R2"},
        {"subscription_id": "U2", "status": "paused", "start_date": "2020-01-02", "end_date": None,
         "customer_id": "K1", "product_id": "R1"},
        {"subscription_id": "U3", "status": "active", "start_date": "2020-02-01", "end_date": "2020-01-01",
         "customer_id": "K9", "product_id": None},
    ],
    "invoices": [
        {"invoice_id": "I1", "issued_at": "2020-01-01", "due_at": "2020-01-01", "total": "100.00", "status": "paid",
         "currency": "usd", "customer_id": "K1"},
        {"invoice_id": "I2", "issued_at": "2020-01-02", "due_at": "2020-01-01", "total": "50.00", "status": "paid",
         "currency": "eur", "customer_id": "K1"},
        {"invoice_id": "I3", "issued_at": "2020-01-03", "total": "20.00", "status": "pending", "currency": "usd",
         "customer_id": "K1"},
        {"invoice_id": "I4", "issued_at": None, "total": None, "status": "paid", "currency": "usd",
         "customer_id": "K2"},
        {"invoice_id": "I5", "issued_at": "2020-01-05", "total": "-1", "status": "void", "currency": "usd",
         "customer_id": "K9"},
    ],
    "invoice_items": [
        {"invoice_item_id": "L1", "quantity": "2", "unit_price": "50.00", "line_total": "100.01", "invoice_id": "I1",
         "product_id": "R1"},
        {"invoice_item_id": "L2", "quantity": "1", "unit_price": "50.00", "line_total": "50.02", "invoice_id": "I2",
         "product_id": "R9"},
        {"invoice_item_id": "L3", "quantity": "x", "unit_price": "1", "line_total": "1", "invoice_id": "I9",
         "product_id": None},
        {"invoice_item_id": "L4", "quantity": "0", "unit_price": "-1", "line_total": "0", "invoice_id": "I4"},
    ],
    "payments": [
        {"payment_id": "Y1", "amount": "99.99", "paid_at": "2020-01-01", "method": "Card", "invoice_id": "I1"},
        {"payment_id": "Y2", "amount": "20", "paid_at": "2020-01-01", "method": "cash", "invoice_id": "I2"},
        {"payment_id": "Y3", "amount": "10", "paid_at": "2020-02-01", "method": "cash", "invoice_id": "I3"},
        {"payment_id": "Y4", "amount": "20.50", "paid_at": None, "method": "coin", "invoice_id": "I3"},
        {"payment_id": "Y5", "amount": "0", "paid_at": "2020-02-01", "method": "cash", "invoice_id": "I3"},
        {"payment_id": "Y6", "amount": "5", "paid_at": "2020-02-01", "method": "cash", "invoice_id": "I9"},
    ],
    "accounts": [
        {"account_id": "A1", "name": "one", "annual_revenue": "0", "employees": "0",
         "created_at": "2020-01-01 00:00:00"},
        {"account_id": "A2", "name": "two", "annual_revenue": "-1", "employees": "x"},
    ],
    "contacts": [
        {"contact_id": "N1", "email": "a@x", "account_id": "A1"},
        {"contact_id": "N2", "email": " ", "account_id": "A2"},
        {"contact_id": "N3", "email": None, "account_id": None},
    ],
    "leads": [
        {"lead_id": "D1", "source": "Web", "status": "converted", "score": "100", "created_at": "2020-01-01"},
        {"lead_id": "D2", "source": "web", "status": "new", "score": "101", "created_at": "2020-01-01"},
        {"lead_id": "D3", "source": "web", "status": "qualified", "score": "1", "created_at": "2020-01-01"},
        {"lead_id": "D4", "source": "ads", "status": "new", "score": None, "created_at": "x"},
    ],
    "opportunities": [
        {"opportunity_id": "O1", "stage": "won", "amount": "10", "created_at": "2020-01-01 23:00:00",
         "close_date": "2020-01-01", "account_id": "A1"},
        {"opportunity_id": "O2", "stage": "proposal", "amount": "0", "created_at": "2020-01-02 00:00:00",
         "close_date": "2020-01-01", "account_id": "A1"},
        {"opportunity_id": "O3", "stage": None, "amount": "5.55", "account_id": None},
    ],
    "opportunity_contacts": [
        {"opportunity_id": "O1", "contact_id": "N1", "role": "technical"},
        {"opportunity_id": "O1", "contact_id": "N2", "role": "boss"},
        {"opportunity_id": "O3", "contact_id": "N3", "role": "financial"},
        {"opportunity_id": "O9", "contact_id": "N1", "role": "end_user"},
    ],
    "activities": [
        {"activity_id": "V1", "type": "call", "contact_id": "N1", "opportunity_id": "O1"},
        {"activity_id": "V2", "type": "call", "contact_id": "N2", "opportunity_id": " "},
        {"activity_id": "V3", "type": "fax", "contact_id": None, "opportunity_id": "O1"},
        {"activity_id": "V4", "type": "note", "contact_id": " ", "opportunity_id": None},
        {"activity_id": "V5", "type": "note", "contact_id": "N1", "opportunity_id": "O3"},
        {"activity_id": "V6", "type": "demo", "contact_id": "N2", "opportunity_id": "O1"},
        {"activity_id": "V7", "type": "demo", "contact_id": "N9", "opportunity_id": "O9"},
    ],
}


def bronze_loader(spark, rows=ROWS):
    stamp = datetime(2024, 1, 1, tzinfo=timezone.utc)

    def load(name: str):
        columns = list(TABLES[name].columns)
        schema = ", ".join(f"`{c}` string" for c in columns)
        data = [tuple(r.get(c) for c in columns) for r in rows[name]]
        return with_lineage(spark.createDataFrame(data, schema), f"{name}.csv", stamp, "batch")

    return load


def fixture_layers(spark) -> Layers:
    return Layers(bronze_loader(spark))
