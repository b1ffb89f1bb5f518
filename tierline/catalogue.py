"""The 18 tables: where they come from, their columns, keys, flags and links.

Column kinds: text, lower, upper, title (trimmed text in that case), optional (trimmed text,
blank becomes NULL), integer, boolean, date, timestamp, decimal(p,s).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from tierline.functions import flags as f

# Accepted codes per column.
ENROLLMENT_STATUS = ("completed", "active", "failed", "dropped")
SUBSCRIPTION_STATUS = ("active", "cancelled", "paused")
INVOICE_STATUS = ("paid", "pending", "overdue")
PAYMENT_METHOD = ("card", "bank_transfer", "paypal", "cash")
LEAD_SOURCE = ("web", "referral", "ads", "event", "cold_call")
LEAD_STATUS = ("new", "contacted", "qualified", "converted", "lost")
OPPORTUNITY_STAGE = ("prospect", "qualification", "proposal", "negotiation", "won", "lost")
OPPORTUNITY_ROLE = ("influencer", "end_user", "financial", "technical", "decision_maker")
ACTIVITY_TYPE = ("email", "call", "meeting", "note", "demo")


@dataclass(frozen=True)
class Link:
    """Flag saying whether `column` names an existing row of `parent`."""

    flag: str
    column: str
    parent: str
    carry: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Table:
    domain: str
    key: tuple[str, ...]
    columns: dict[str, str]  # bronze column -> kind
    rename: dict[str, str] = field(default_factory=dict)  # bronze column -> silver column
    derived: dict[str, tuple[str, str]] = field(default_factory=dict)  # name -> (SQL, insert after)
    flags: dict[str, str] = field(default_factory=dict)  # name -> SQL
    links: tuple[Link, ...] = ()
    after_links: dict[str, str] = field(default_factory=dict)  # flags that need carried columns
    order: tuple[str, ...] = ()  # order of the flags in the output, where it matters

    def silver_columns(self) -> list[str]:
        names = [self.rename.get(c, c) for c in self.columns]
        for name, (_, after) in self.derived.items():
            names.insert(names.index(after) + 1, name)
        if self.order:
            return names + list(self.order)
        return names + [*self.flags, *[ln.flag for ln in self.links], *self.after_links]


# Columns, kinds, keys, flags and links of the tables.
TABLES: dict[str, Table] = {
    "students": Table(
        "university",
        ("student_id",),
        {
            "student_id": "text", "first_name": "title", "last_name": "title", "email": "lower",
            "birth_date": "date", "enrolled_at": "timestamp", "country": "upper",
        },
        flags={"is_temporally_valid": f.in_order("birth_date", "cast(enrolled_at AS date)", strict=True)},
    ),
    "professors": Table(
        "university",
        ("professor_id",),
        {
            "professor_id": "text", "first_name": "title", "last_name": "title", "email": "lower",
            "department": "text", "hired_at": "timestamp",
        },
    ),
    "courses": Table(
        "university",
        ("course_id",),
        {
            "course_id": "text", "code": "upper", "name": "text", "credits": "integer",
            "department": "text", "professor_id": "text",
        },
    ),
    "semesters": Table(
        "university",
        ("semester_id",),
        {
            "semester_id": "text", "code": "upper", "year": "integer", "half": "integer",
            "start_date": "date", "end_date": "date",
        },
        flags={"is_temporally_valid": f.in_order("start_date", "end_date")},
    ),
    "enrollments": Table(
        "university",
        ("enrollment_id",),
        {
            "enrollment_id": "text", "enrolled_at": "date", "status": "lower", "student_id": "text",
            "course_id": "text", "semester_id": "text",
        },
        order=("is_repeated_combination",),
    ),
    "grades": Table(
        "university",
        ("grade_id",),
        {
            "grade_id": "text", "assessment": "lower", "score": "decimal(6,2)", "weight": "decimal(5,4)",
            "graded_at": "date", "enrollment_id": "text",
        },
        derived={"total_weight": ("try_cast(_weight_sum AS decimal(8,4))", "weight")},
        flags={
            "is_score_valid": f.between("score", 0, 100),
            "is_weight_valid": f.holds("weight > 0 AND weight <= 1"),
            "is_weight_sum_one": f.holds("_weight_missing = 0 AND total_weight = 1"),
        },
    ),
    "customers": Table(
        "billing",
        ("customer_id",),
        {
            "customer_id": "text", "external_ref": "text", "first_name": "title", "last_name": "title",
            "email": "lower", "country": "upper", "created_at": "timestamp", "segment": "lower",
        },
        links=(Link("is_student_linked", "external_ref", "students"),),
    ),
    "products": Table(
        "billing",
        ("product_id",),
        {
            "product_id": "text", "sku": "upper", "name": "text", "category": "lower",
            "monthly_price": "decimal(10,2)", "active": "boolean",
        },
    ),
    "subscriptions": Table(
        "billing",
        ("subscription_id",),
        {
            "subscription_id": "text", "status": "lower", "start_date": "date", "end_date": "date",
            "customer_id": "text", "product_id": "text",
        },
        flags={"is_temporally_valid": f.in_order("start_date", "end_date")},
        links=(
            Link("is_customer_linked", "customer_id", "customers"),
            Link("is_product_linked", "product_id", "products"),
        ),
    ),
    "invoices": Table(
        "billing",
        ("invoice_id",),
        {
            "invoice_id": "text", "issued_at": "date", "due_at": "date", "total": "decimal(12,2)",
            "status": "lower", "currency": "upper", "customer_id": "text",
        },
        flags={
            "is_temporally_valid": f.in_order("issued_at", "due_at"),
            "is_total_valid": f.holds("total >= 0"),
        },
        links=(Link("is_customer_linked", "customer_id", "customers"),),
    ),
    "invoice_items": Table(
        "billing",
        ("invoice_item_id",),
        {
            "invoice_item_id": "text", "quantity": "integer", "unit_price": "decimal(12,2)",
            "line_total": "decimal(14,2)", "invoice_id": "text", "product_id": "text",
        },
        derived={
            "calculated_line_total": ("try_cast(round(quantity * unit_price, 2) AS decimal(14,2))", "line_total")
        },
        flags={
            "is_quantity_valid": f.holds("quantity > 0"),
            "is_unit_price_valid": f.holds("unit_price >= 0"),
            "is_line_total_valid": f.close("line_total", "calculated_line_total", "0.01"),
        },
        links=(
            Link("is_invoice_linked", "invoice_id", "invoices"),
            Link("is_product_linked", "product_id", "products"),
        ),
    ),
    "payments": Table(
        "billing",
        ("payment_id",),
        {
            "payment_id": "text", "amount": "decimal(12,2)", "paid_at": "date", "method": "lower",
            "invoice_id": "text",
        },
        flags={"is_amount_valid": f.holds("amount > 0"), "is_method_valid": f.member("method", PAYMENT_METHOD)},
        links=(Link("is_invoice_linked", "invoice_id", "invoices", {"issued_at": "_issued_at"}),),
        after_links={"is_temporally_valid": f.in_order("_issued_at", "paid_at")},
    ),
    "accounts": Table(
        "crm",
        ("account_id",),
        {
            "account_id": "text", "name": "text", "industry": "lower", "country": "upper",
            "annual_revenue": "decimal(16,2)", "employees": "integer", "created_at": "timestamp",
        },
        flags={
            "is_annual_revenue_valid": f.holds("annual_revenue >= 0"),
            "is_employees_valid": f.holds("employees >= 0"),
            "is_created_at_valid": f.known("created_at"),
        },
    ),
    "contacts": Table(
        "crm",
        ("contact_id",),
        {
            "contact_id": "text", "first_name": "title", "last_name": "title", "email": "lower",
            "phone": "text", "title": "text", "created_at": "timestamp", "account_id": "text",
        },
        flags={"is_email_present": f.filled("email"), "is_created_at_valid": f.known("created_at")},
        links=(Link("is_account_linked", "account_id", "accounts"),),
    ),
    "leads": Table(
        "crm",
        ("lead_id",),
        {
            "lead_id": "text", "first_name": "title", "last_name": "title", "email": "lower",
            "source": "lower", "status": "lower", "score": "integer", "created_at": "timestamp",
        },
        flags={
            "is_email_present": f.filled("email"),
            "is_source_valid": f.member("source", LEAD_SOURCE),
            "is_status_valid": f.member("status", LEAD_STATUS),
            "is_score_valid": f.between("score", 0, 100),
            "is_created_at_valid": f.known("created_at"),
        },
    ),
    "opportunities": Table(
        "crm",
        ("opportunity_id",),
        {
            "opportunity_id": "text", "name": "text", "stage": "lower", "amount": "decimal(16,2)",
            "close_date": "date", "created_at": "timestamp", "account_id": "text",
        },
        flags={
            "is_stage_valid": f.member("stage", OPPORTUNITY_STAGE),
            "is_amount_valid": f.holds("amount > 0"),
            "is_temporally_valid": f.in_order("cast(created_at AS date)", "close_date"),
        },
        links=(Link("is_account_linked", "account_id", "accounts"),),
    ),
    "opportunity_contacts": Table(
        "crm",
        ("opportunity_id", "contact_id"),
        {"opportunity_id": "text", "contact_id": "text", "role": "lower"},
        flags={"is_role_valid": f.member("role", OPPORTUNITY_ROLE)},
        links=(
            Link("is_opportunity_linked", "opportunity_id", "opportunities", {"account_id": "_deal_account"}),
            Link("is_contact_linked", "contact_id", "contacts", {"account_id": "_person_account"}),
        ),
        after_links={"is_same_account": f.holds("_deal_account = _person_account")},
    ),
    "activities": Table(
        "crm",
        ("activity_id",),
        {
            "activity_id": "text", "type": "lower", "subject": "text", "occurred_at": "timestamp",
            "contact_id": "optional", "opportunity_id": "optional",
        },
        rename={"type": "activity_type"},
        flags={
            "is_type_valid": f.member("activity_type", ACTIVITY_TYPE),
            "is_occurred_at_valid": f.known("occurred_at"),
            "has_contact_id": f.known("contact_id"),
            "has_opportunity_id": f.known("opportunity_id"),
            "has_any_reference": "contact_id IS NOT NULL OR opportunity_id IS NOT NULL",
        },
        links=(
            Link("is_contact_linked", "contact_id", "contacts"),
            Link("is_opportunity_linked", "opportunity_id", "opportunities"),
        ),
    ),
}

# child table, child column, parent table, may be NULL. The parent column is the parent's key.
# Child, column, parent, may the column be missing.
RELATIONS: tuple[tuple[str, str, str, bool], ...] = (
    ("courses", "professor_id", "professors", False),
    ("enrollments", "student_id", "students", False),
    ("enrollments", "course_id", "courses", False),
    ("enrollments", "semester_id", "semesters", False),
    ("grades", "enrollment_id", "enrollments", False),
    ("subscriptions", "customer_id", "customers", False),
    ("subscriptions", "product_id", "products", False),
    ("invoices", "customer_id", "customers", False),
    ("invoice_items", "invoice_id", "invoices", False),
    ("invoice_items", "product_id", "products", False),
    ("payments", "invoice_id", "invoices", False),
    ("contacts", "account_id", "accounts", False),
    ("opportunities", "account_id", "accounts", False),
    ("opportunity_contacts", "opportunity_id", "opportunities", False),
    ("opportunity_contacts", "contact_id", "contacts", False),
    ("activities", "contact_id", "contacts", True),
    ("activities", "opportunity_id", "opportunities", True),
)

# Columns of codes.
CATEGORICAL: dict[str, tuple[str, ...]] = {
    "students": ("country",),
    "professors": ("department",),
    "courses": ("department",),
    "semesters": ("half",),
    "enrollments": ("status",),
    "grades": ("assessment",),
    "customers": ("country", "segment"),
    "products": ("category", "active"),
    "subscriptions": ("status",),
    "invoices": ("status", "currency"),
    "payments": ("method",),
    "accounts": ("industry", "country"),
    "contacts": ("title",),
    "leads": ("source", "status"),
    "opportunities": ("stage",),
    "opportunity_contacts": ("role",),
    "activities": ("type",),
}

LINEAGE = ("_source_file", "_ingested_at", "_batch_id")
SILVER_LINEAGE = ("_source_file", "_bronze_ingested_at", "_batch_id", "_silver_created_at")


def columns_of_kind(*kinds: str) -> list[tuple[str, str]]:
    return [(name, col) for name, t in TABLES.items() for col, kind in t.columns.items() if kind in kinds]


def source_file(name: str) -> str:
    return f"{name}.csv"
