from __future__ import annotations

from decimal import Decimal as D

import pytest

from fixture_rows import ROWS, bronze_loader, fixture_layers
from tierline.plans import kpis, profiling, rules
from tierline.plans.layers import Layers


@pytest.fixture(scope="module")
def layers(spark):
    return fixture_layers(spark)


def rows(df, *key):
    return {"+".join(str(r[k]) for k in key): r for r in df.collect()}


def test_grades_by_enrollment(layers):
    found = rows(layers.gold("grades_by_enrollment"), "enrollment_id")
    assert found["E1"]["weighted_average_observed"] == D("85.50") and found["E1"]["is_weight_sum_one"]
    assert found["E2"]["weighted_average_observed"] == D("0.00") and not found["E2"]["is_weight_sum_one"]
    assert found["E3"]["weighted_average_observed"] is None
    assert found["E4"]["weighted_average_observed"] is None  # weight above 1


def test_weight_flag_equals_the_silver_flag(layers):
    silver = layers.silver("grades").groupBy("enrollment_id").agg({"is_weight_sum_one": "bool_and"}).collect()
    gold = rows(layers.gold("grades_by_enrollment"), "enrollment_id")
    assert {str(r[0]): r[1] for r in silver} == {k: r["is_weight_sum_one"] for k, r in gold.items()}


def test_student_summary(layers):
    found = rows(layers.gold("student_academic_summary"), "student_id")
    one = found["S1"]
    assert (one["total_enrollments"], one["completed_enrollments"], one["failed_enrollments"]) == (3, 1, 1)
    assert one["average_weighted_observed_score"] == D("42.75")  # mean of 85.50 and 0.00
    assert found["S2"]["total_enrollments"] == 0 and found["S2"]["average_weighted_observed_score"] is None
    assert found["S3"]["student_name"] == "Solo"


def test_course_summary(layers):
    found = rows(layers.gold("course_performance_summary"), "course_id")
    one = found["C1"]
    assert (one["total_enrollments"], one["distinct_students"], one["semesters_offered"]) == (5, 1, 2)
    assert (one["first_year_offered"], one["last_year_offered"]) == (2020, 2021)
    assert one["temporally_invalid_semester_enrollments"] == 1
    assert one["completion_rate_pct"] == D("20.00")
    assert found["C2"]["completion_rate_pct"] is None and found["C2"]["professor_name"] == ""


def test_invoice_detail(layers):
    found = rows(layers.gold("invoice_detail"), "invoice_id")
    status = {k: r["payment_balance_status"] for k, r in found.items()}
    assert status == {"I1": "exactly_paid", "I2": "underpaid", "I3": "overpaid", "I4": "underpaid", "I5": "overpaid"}
    assert found["I1"]["does_invoice_match_items"] and not found["I2"]["does_invoice_match_items"]
    assert found["I3"]["does_invoice_match_items"] is None and found["I3"]["is_without_items"]
    assert found["I4"]["outstanding_amount"] == 0 and found["I4"]["does_invoice_match_items"] is False
    assert found["I2"]["is_paid_status_underpaid"] and not found["I1"]["is_paid_status_underpaid"]
    assert found["I3"]["is_open_status_fully_paid"] and found["I3"]["overpaid_amount"] == D("10.50")
    assert found["I3"]["payment_count"] == 2 and found["I3"]["payment_method_count"] == 2


def test_billing_summary_splits_currencies(layers):
    found = rows(layers.gold("customer_billing_summary"), "customer_id", "currency")
    assert set(found) == {"K1+USD", "K1+EUR", "K2+USD"}
    usd = found["K1+USD"]
    assert (usd["invoice_count"], usd["total_invoiced"], usd["total_paid"]) == (2, D("120.00"), D("130.49"))
    assert usd["outstanding_amount"] == D("0.01") and usd["overpaid_amount"] == D("10.50")
    kpi = rows(layers.gold("billing_currency_kpis"), "currency")
    assert kpi["USD"]["customers"] == 2 and kpi["USD"]["total_invoices"] == 3
    assert kpi["EUR"]["invoice_item_mismatch_rate_pct"] == D("100.00")


def test_subscription_summary(layers):
    found = rows(layers.gold("customer_subscription_summary"), "customer_id")
    one = found["K1"]
    assert (one["total_subscriptions"], one["distinct_products"], one["active_distinct_products"]) == (2, 2, 1)
    assert (one["subscriptions_to_active_products"], one["subscriptions_to_inactive_products"]) == (1, 1)
    assert one["active_subscriptions_to_inactive_products"] == 1
    assert found["K2"]["total_subscriptions"] == 0


def test_activity_assignment(layers):
    found = rows(layers.gold("activity_assignment"), "activity_id")
    accounts = [found[f"V{i}"]["assigned_account_id"] for i in range(1, 8)]
    # V5: the linked opportunity has no account, so the contact's account is not used.
    assert accounts == ["A1", "A2", "A1", None, None, "A1", None]
    kinds = [found[f"V{i}"]["reference_type"] for i in range(1, 5)]
    assert kinds == ["contact_and_opportunity", "contact_only", "opportunity_only", "no_reference"]
    assert found["V1"]["both_references_same_account"] and found["V6"]["both_references_different_account"]
    assert found["V5"]["both_references_different_account"]


def test_account_summary(layers):
    found = rows(layers.gold("account_crm_summary"), "account_id")
    one = found["A1"]
    assert (one["total_opportunities"], one["won_opportunities"], one["open_opportunities"]) == (2, 1, 1)
    assert one["total_crm_opportunity_amount"] == D("10.00") and one["open_pipeline_crm_amount"] == 0
    assert one["closed_opportunity_win_rate_pct"] == D("100.00")
    assert (one["opportunity_contact_relationships"], one["same_account_relationships"]) == (2, 1)
    assert found["A2"]["closed_opportunity_win_rate_pct"] is None and found["A2"]["total_activities"] == 1


def test_lead_funnel(layers):
    found = rows(layers.gold("lead_funnel_summary"), "source")
    web = found["web"]
    assert web["average_lead_score"] == D("50.50") and web["conversion_rate_pct"] == D("33.33")
    assert web["qualified_or_converted_rate_pct"] == D("66.67") and web["leads_with_quality_issue"] == 1
    assert found["ads"]["average_lead_score"] is None and found["ads"]["conversion_rate_pct"] == 0


def test_executive_kpis(layers):
    row = layers.gold("executive_kpis").first()
    assert row["total_students"] == 3 and row["customers_without_invoices"] == 2
    assert row["total_activities"] == 7 and row["unassigned_activities"] == 1
    assert row["assigned_activities"] == 4
    assert list(row.asDict())[1:] == kpis.EXECUTIVE_COLUMNS


def test_student_360(layers):
    found = rows(layers.gold("student_customer_360"), "student_id")
    assert found["S1"]["billing_currency_count"] == 2 and found["S1"]["has_billing_reconciliation_issue"]
    assert found["S2"]["customer_id"] is None and found["S2"]["has_active_subscription"] is None
    assert found["S2"]["has_invoices"] is False


def test_a_student_named_by_two_customers_has_two_rows(spark):
    more = {**ROWS, "customers": [*ROWS["customers"], {"customer_id": "K5", "external_ref": "S1 "}]}
    found = Layers(bronze_loader(spark, more)).gold("student_customer_360").collect()
    pairs = sorted((r["student_id"], r["customer_id"] or "", r["total_invoices"]) for r in found)
    assert pairs == [("S1", "K1", 3), ("S1", "K5", 0), ("S2", "", 0), ("S3", "", 0)]


def test_gold_row_counts_follow_from_inputs(layers):
    assert {r["state"] for r in rules.gold_conservation(layers).collect()} == {"OK"}


def test_rules_and_reports(layers):
    found = {r["rule"]: r["violations"] for r in rules.table_report(layers, "enrollments").collect()}
    assert found["status_invalid"] == 1 and found["combination_repeated"] == 4 and found["combination_groups"] == 2
    assert found["key_duplicated"] == 0 and found["student_id_orphans"] == 0
    courses = {r["rule"]: r["violations"] for r in rules.table_report(layers, "courses").collect()}
    assert courses["professor_id_orphans"] == 1 and courses["credits_null"] == 1
    products = {r["rule"]: r["violations"] for r in rules.table_report(layers, "products").collect()}
    assert products["sku_duplicated"] == 1 and products["monthly_price_negative"] == 1


def test_business_rules(layers):
    found = {r["codigo"]: r for r in profiling.business_rules(layers).collect()}
    assert found["UNI-01"]["registros_invalidos"] == 2 and found["UNI-02"]["registros_invalidos"] == 1
    assert found["UNI-03"]["registros_invalidos"] == 4
    assert (found["UNI-04"]["registros_evaluados"], found["UNI-04"]["registros_invalidos"]) == (4, 1)
    assert found["BIL-03"]["registros_invalidos"] == 2  # 0.02 off, and an unconvertible quantity
    assert found["BIL-06"]["registros_invalidos"] == 2 and found["BIL-07"]["registros_invalidos"] == 2
    assert found["CRM-03"]["registros_invalidos"] == 2 and found["CRM-04"]["estado"] == "OK"
    sample = profiling.rule_examples(layers, "UNI-01").collect()
    assert [r["grade_id"] for r in sample] == ["G4", "G6"]


def test_parts_of_the_account_summary_that_nobody_reads_are_not_made(layers):
    """Each part has a row an account, so Catalyst drops its join: accounts, their deals and the deals' accounts remain."""
    plan = lambda *c: layers.gold("account_crm_summary").select(*c)._jdf.queryExecution().optimizedPlan().toString()
    assert plan("account_id", "won_opportunities").count("Join") == 2
    assert plan("account_id").count("Join") == 0


def test_an_activity_meets_each_parent_once(layers):
    plan = layers.gold("activity_assignment")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2


def test_metrics_of_opportunity_contacts_read_the_relations_once(layers):
    plan = layers.gold("opportunity_contact_metrics")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2


def test_a_join_for_rules_is_made_of_its_own_keys(layers):
    """Rules over an item's invoice and over its product are counted apart, so that neither join carries the other's rows."""
    plan = rules.rule_counts(layers, "invoice_items")._jdf.queryExecution().optimizedPlan().toString()
    depths = [len(line) - len(line.lstrip(" :+-")) for line in plan.splitlines() if "Join" in line]
    assert len(depths) == 2 and len(set(depths)) == 1
    items = layers.silver("invoice_items")
    found = {r["rule"]: r["violations"] for r in rules.rule_counts(layers, "invoice_items").collect()}
    assert list(found) == [rules.KEY_MISSING, *rules.RULES["invoice_items"]]
    assert found == {rule: items.filter(sql).count() for rule, sql in {rules.KEY_MISSING: rules.null_key("invoice_items"), **rules.RULES["invoice_items"]}.items()}


def test_rows_of_a_link_are_shuffled_without_a_hash(layers):
    plan = layers.silver("activities").select("is_contact_linked")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and not [line for line in plan.splitlines() if "xxhash64(_key" in line and "Join" not in line]
    assert "_key_hash" not in plan and "_ref_hash" not in plan
