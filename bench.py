"""Time the queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

The headline queries come first and make up the value; all others follow, as long as $BENCH_SECONDS are not over.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from tierline.queries import QUERIES
from tierline.session import build_session

HEADLINE = [
    "invoice_reconciliation_by_status",
    "silver_enrollments",
    "silver_grades",
    "silver_invoices",
    "silver_invoice_items",
    "silver_payments",
    "silver_opportunity_contacts",
    "silver_activities",
    "grades_by_enrollment",
    "invoice_detail",
    "activity_assignment",
    "student_academic_summary",
    "course_performance_summary",
    "customer_billing_summary",
    "customer_subscription_summary",
    "account_crm_summary",
    "lead_funnel_summary",
    "billing_currency_kpis",
    "executive_kpis",
    "student_customer_360",
    "billing_customer_dashboard",
    "dq_rule_counts",
    "dq_orphans",
    "dq_duplicate_keys",
    "profile_tables",
    "profile_columns",
    "profile_foreign_keys",
    "business_rules",
    "observed_score_histogram",
    "top_open_pipeline",
    "student_360_by_situation",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or [*HEADLINE, *(q for q in QUERIES if q not in HEADLINE)]
    limit = float(os.environ.get("BENCH_SECONDS", "900"))
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g",
                                      "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES[names[0]](spark, folder).write.format("noop").mode("overwrite").save()  # start the JVM's code paths
    seconds, begun = {}, time.perf_counter()
    for name in names:
        start = time.perf_counter()
        if name not in HEADLINE and start - begun > limit:
            break
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(s for q, s in seconds.items() if q in HEADLINE or sys.argv[1:]), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
