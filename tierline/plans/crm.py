"""Gold tables of the CRM domain, which shares no key with the other two."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.exact import mean, money, percent
from tierline.operators.links import hot_key_join
from tierline.operators.measures import add, aggregate, n, per_code, same, sum_if, zero

_OPEN = "stage NOT IN ('won', 'lost')"
_STAGES = {f"{s}_opportunities": s for s in ("prospect", "qualification", "proposal", "negotiation", "won", "lost")}
_ROLES = {
    f"{r}_relationships": r for r in ("decision_maker", "end_user", "financial", "influencer", "technical")
}
_TYPES = {f"{t}_activities": t for t in ("call", "demo", "email", "meeting", "note")}

_CONTACT_COUNTS = {
    "total_contacts": "count(*)",
    "contacts_with_email": n("is_email_present"),
    "contacts_without_email": n("NOT is_email_present"),
}


def _of_accounts(layers, metrics: DataFrame) -> DataFrame:
    """The groups whose account exists; rows are summed by account before accounts are looked up."""
    accounts = layers.reference("accounts", "account_id").selectExpr("account_id AS _ref").distinct()
    return metrics.join(accounts, F.expr("account_id = _ref"), "left_semi")


def contact_metrics(layers) -> DataFrame:
    dates = {"first_contact_created_at": "min(created_at)", "latest_contact_created_at": "max(created_at)"}
    return _of_accounts(layers, aggregate(layers.silver("contacts"), same("account_id"), {**_CONTACT_COUNTS, **dates}))


_OPPORTUNITY_COUNTS = {
    "total_opportunities": "count(*)",
    **per_code("stage", _STAGES),
    "open_opportunities": n(_OPEN),
    "temporally_invalid_opportunities": n("NOT is_temporally_valid"),
}
_AMOUNTS = {
    "total_crm_opportunity_amount": "true",
    "won_crm_amount": "stage = 'won'",
    "lost_crm_amount": "stage = 'lost'",
    "open_pipeline_crm_amount": _OPEN,
}


def opportunity_metrics(layers) -> DataFrame:
    metrics = aggregate(
        layers.silver("opportunities"),
        same("account_id"),
        {
            **_OPPORTUNITY_COUNTS,
            **{name: money(sum_if("amount", f"is_amount_valid AND {cond}")) for name, cond in _AMOUNTS.items()},
            "average_crm_opportunity_amount": mean("if(is_amount_valid, amount, NULL)"),
            "first_opportunity_created_at": "min(created_at)",
            "latest_opportunity_created_at": "max(created_at)",
            "earliest_close_date": "min(close_date)",
            "latest_close_date": "max(close_date)",
        },
    )
    return _of_accounts(layers, metrics)


_RELATION_COUNTS = {
    "opportunity_contact_relationships": "count(*)",
    "same_account_relationships": n("is_same_account"),
    "different_account_relationships": n("NOT is_same_account"),
}


def opportunity_contact_metrics(layers) -> DataFrame:
    """Per account of the opportunity, over the relations whose opportunity and contact both exist.

    A relation meets its contact, then its opportunity, with nothing but its keys and the number of its role. One aggregate
    counts relations, distinct opportunities and distinct contacts.
    """
    role = f"cast(coalesce(array_position(array({', '.join(f"'{r}'" for r in _ROLES.values())}), role), 0) AS tinyint)"
    relations = layers.reference("opportunity_contacts", "opportunity_id", "contact_id", "role").selectExpr("opportunity_id", "contact_id", f"{role} AS _role")
    owner = {"_owner": "min(account_id)"}
    deals = aggregate(layers.reference("opportunities", "opportunity_id", "account_id"), {"_deal": "opportunity_id"}, owner)
    people = aggregate(layers.reference("contacts", "contact_id", "account_id"), {"_person": "contact_id"}, {"_employer": "min(account_id)"})
    met = hot_key_join(relations, people, "contact_id", "_person", "opportunity_id", how="inner", stored=False)
    owned = hot_key_join(met, deals, "opportunity_id", "_deal", "contact_id", how="inner", stored=False)
    same_account = "coalesce(_owner = _employer, false)"
    return aggregate(
        owned,
        {"account_id": "_owner"},
        {
            "opportunity_contact_relationships": "count(*)",
            "same_account_relationships": n(same_account),
            "different_account_relationships": n(f"NOT {same_account}"),
            "opportunities_with_contacts": "count(DISTINCT opportunity_id)",
            "distinct_contacts_in_opportunities": "count(DISTINCT contact_id)",
            **{c: n(f"_role = {i}") for i, c in enumerate(_ROLES, 1)},
        },
    )


def activity_assignment(layers) -> DataFrame:
    """One row per activity: a linked opportunity decides the account, else a linked contact does.

    A linked opportunity without an account leaves the activity unassigned.
    """
    people = layers.reference("contacts", "contact_id", "account_id").selectExpr("contact_id AS _person", "account_id AS _person_account", "true AS _person_is")
    deals = layers.reference("opportunities", "opportunity_id", "account_id").selectExpr("opportunity_id AS _deal", "account_id AS _deal_account", "true AS _deal_is")
    # The parents that are met here say what the links of silver would, which so are not made.
    joined = hot_key_join(layers.silver("activities"), people, "contact_id", "_person", "activity_id", stored=False)
    joined = hot_key_join(joined, deals, "opportunity_id", "_deal", "activity_id", stored=False)
    joined = add(joined.drop("is_contact_linked", "is_opportunity_linked"), {"is_contact_linked": "_person_is IS NOT NULL", "is_opportunity_linked": "_deal_is IS NOT NULL"})
    both = "is_contact_linked AND is_opportunity_linked"
    return joined.selectExpr(
        "activity_id",
        "activity_type",
        "occurred_at",
        "CASE WHEN is_opportunity_linked THEN _deal_account WHEN is_contact_linked THEN _person_account END"
        " AS assigned_account_id",
        "CASE WHEN NOT has_any_reference THEN 'no_reference' WHEN NOT has_opportunity_id THEN 'contact_only'"
        " WHEN NOT has_contact_id THEN 'opportunity_only' ELSE 'contact_and_opportunity' END AS reference_type",
        f"{both} AND coalesce(_person_account = _deal_account, false) AS both_references_same_account",
        f"{both} AND NOT (_person_account <=> _deal_account) AS both_references_different_account",
    )


_ACTIVITY_COUNTS = {
    "total_activities": "count(*)",
    **per_code("activity_type", _TYPES),
    **per_code(
        "reference_type",
        {f"{r}_activities": r for r in ("contact_only", "opportunity_only", "contact_and_opportunity")},
    ),
    "activities_with_same_account_references": n("both_references_same_account"),
    "activities_with_different_account_references": n("both_references_different_account"),
}


def activity_metrics(layers) -> DataFrame:
    assigned = layers.gold("activity_assignment").filter("assigned_account_id IS NOT NULL")
    dates = {"first_activity_at": "min(occurred_at)", "latest_activity_at": "max(occurred_at)"}
    return aggregate(assigned, {"account_id": "assigned_account_id"}, {**_ACTIVITY_COUNTS, **dates})


def account_crm_summary(layers) -> DataFrame:
    """One row per account, left-joined to four results that each have one row per account."""
    joined = layers.silver("accounts").withColumnRenamed("created_at", "account_created_at")
    for i, part in enumerate(
        ("contact_metrics", "opportunity_metrics", "opportunity_contact_metrics", "activity_metrics")
    ):
        metrics = layers.gold(part).withColumnRenamed("account_id", f"_account_{i}")
        joined = joined.join(metrics, F.expr(f"account_id = _account_{i}"), "left")
    closed = "won_opportunities + lost_opportunities"
    distinct = ["opportunities_with_contacts", "distinct_contacts_in_opportunities"]
    return joined.selectExpr(
        "account_id",
        "name AS account_name",
        "industry",
        "country",
        "annual_revenue",
        "employees",
        "account_created_at",
        "is_annual_revenue_valid",
        "is_employees_valid",
        "is_created_at_valid",
        *zero(_CONTACT_COUNTS),
        "first_contact_created_at",
        "latest_contact_created_at",
        *zero(_OPPORTUNITY_COUNTS),
        *[f"{money(f'coalesce({c}, 0)')} AS {c}" for c in _AMOUNTS],
        "average_crm_opportunity_amount",
        f"{percent('won_opportunities', closed)} AS closed_opportunity_win_rate_pct",
        "first_opportunity_created_at",
        "latest_opportunity_created_at",
        "earliest_close_date",
        "latest_close_date",
        *zero([*_RELATION_COUNTS, *distinct, *_ROLES]),
        *zero(_ACTIVITY_COUNTS),
        "first_activity_at",
        "latest_activity_at",
    )


def lead_funnel_summary(layers) -> DataFrame:
    score = "if(is_score_valid, score, NULL)"
    funnel = aggregate(
        layers.silver("leads"),
        same("source"),
        {
            "total_leads": "count(*)",
            **per_code("status", {f"{s}_leads": s for s in ("new", "contacted", "qualified", "converted", "lost")}),
            "leads_with_email": n("is_email_present"),
            "leads_without_email": n("NOT is_email_present"),
            "average_lead_score": mean(score, digits=0),
            "minimum_lead_score": f"min({score})",
            "maximum_lead_score": f"max({score})",
            "first_lead_created_at": "min(created_at)",
            "latest_lead_created_at": "max(created_at)",
            "leads_with_quality_issue": n(
                "NOT (is_source_valid AND is_status_valid AND is_score_valid AND is_created_at_valid)"
            ),
        },
    )
    return add(
        funnel,
        {
            "conversion_rate_pct": percent("converted_leads", "total_leads"),
            "qualified_or_converted_rate_pct": percent("qualified_leads + converted_leads", "total_leads"),
        },
    )
