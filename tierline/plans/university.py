"""Gold tables of the university domain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions.exact import half_up, percent
from tierline.operators.links import hot_key_join
from tierline.operators.measures import FULL_NAME, aggregate, count_of, n, per_code, same, sum_if, zero

_STATUS = {f"{s}_enrollments": s for s in ("completed", "active", "failed", "dropped")}
_GRADED = "status IN ('completed', 'failed') AND weighted_average_observed IS NOT NULL"


def grades_by_enrollment(layers) -> DataFrame:
    """Weighted mean per enrollment; weights are relative, so they need not add up to 1.

    `is_weight_sum_one` restates the silver flag from the weights: all grades of an enrollment
    share it, and this way the silver join that spreads it over the rows is not needed here.
    """
    usable = "bool_and(is_score_valid) AND bool_and(is_weight_valid) AND sum(weight) > 0"
    average = half_up("sum(score * weight)", "sum(weight)", 2, digits=6)
    return aggregate(
        layers.silver("grades"),
        same("enrollment_id"),
        {
            "grade_records": "count(*)",
            "all_scores_valid": "bool_and(is_score_valid)",
            "all_weights_valid": "bool_and(is_weight_valid)",
            "observed_weight_sum": "cast(sum(weight) AS decimal(18,4))",
            "weighted_average_observed": f"if({usable}, {average}, NULL)",
            "is_weight_sum_one": "coalesce(count(*) = count(weight) AND sum(weight) = 1, false)",
        },
    )


def _graded_enrollments(layers) -> DataFrame:
    """Enrollments with their grade summary; both sides have one row per enrollment."""
    grades = layers.gold("grades_by_enrollment").selectExpr(
        "enrollment_id AS _graded", "weighted_average_observed", "is_weight_sum_one"
    )
    return layers.silver("enrollments").join(grades, F.expr("enrollment_id = _graded"), "left")


# Counts over graded enrollments; the score sum stays apart so that groups can be merged exactly.
_COUNTS = {
    "total_enrollments": "count(*)",
    **per_code("status", _STATUS),
    "repeated_combination_enrollments": n("is_repeated_combination"),
    "enrollments_with_grades": n("_graded IS NOT NULL"),
}
_WEIGHT_COUNTS = {
    "weight_sum_one_enrollments": n("_graded IS NOT NULL AND is_weight_sum_one"),
    "weight_sum_not_one_enrollments": n("_graded IS NOT NULL AND NOT is_weight_sum_one"),
}
_SCORED = {"enrollments_with_observed_average": n(_GRADED)}
_SCORE_SUM = {"_score_sum": sum_if("weighted_average_observed", _GRADED)}
_AVERAGE = half_up("_score_sum", "enrollments_with_observed_average", 2, digits=2) + " AS average_weighted_observed_score"


def student_academic_summary(layers) -> DataFrame:
    counts = {**_COUNTS, **_WEIGHT_COUNTS, **_SCORED}
    metrics = aggregate(_graded_enrollments(layers), {"_student": "student_id"}, {**counts, **_SCORE_SUM})
    joined = layers.silver("students").join(metrics, F.expr("student_id = _student"), "left")
    return joined.selectExpr(
        "student_id",
        f"{FULL_NAME} AS student_name",
        "email",
        "country",
        "enrolled_at",
        "is_temporally_valid AS is_student_temporally_valid",
        *zero(counts),
        _AVERAGE,
    )


def _course_metrics(layers) -> DataFrame:
    """Per course, in two levels: first per (course, semester), which is where semesters are joined.

    Only the pairs of the first level meet the semester table, and the semester count falls out of
    them, so no distinct aggregate is left on the raw rows.
    """
    counts = {**_COUNTS, **_SCORED}
    per_semester = aggregate(
        _graded_enrollments(layers), same("course_id", "semester_id"), {**counts, **_SCORE_SUM}
    )
    semesters = layers.silver("semesters").selectExpr("semester_id AS _semester", "year", "is_temporally_valid")
    return aggregate(
        per_semester.join(semesters, F.expr("semester_id = _semester"), "left"),
        {"_course": "course_id"},
        {
            **{c: f"sum({c})" for c in (*counts, *_SCORE_SUM)},
            "semesters_offered": "count(semester_id)",
            "first_year_offered": "min(year)",
            "last_year_offered": "max(year)",
            "temporally_invalid_semester_enrollments": count_of("total_enrollments", "NOT is_temporally_valid"),
        },
    )


def course_performance_summary(layers) -> DataFrame:
    pairs = layers.reference("enrollments", "course_id", "student_id").distinct()
    attendance = aggregate(pairs, {"_attended": "course_id"}, {"distinct_students": "count(student_id)"})
    professors = layers.silver("professors").selectExpr(
        "professor_id AS _professor", f"{FULL_NAME} AS professor_name", "department AS professor_department"
    )
    joined = (
        hot_key_join(layers.silver("courses"), professors, "professor_id", "_professor", "course_id")
        .join(_course_metrics(layers), F.expr("course_id = _course"), "left")
        .join(attendance, F.expr("course_id = _attended"), "left")
    )
    rates = {"completion_rate_pct": "completed", "failure_rate_pct": "failed", "dropout_rate_pct": "dropped"}
    return joined.selectExpr(
        "course_id",
        "code AS course_code",
        "name AS course_name",
        "credits",
        "department",
        "professor_id",
        "coalesce(professor_name, '') AS professor_name",
        "professor_department",
        *zero(["total_enrollments", "distinct_students", "semesters_offered"]),
        *zero([*list(_COUNTS)[1:], *_SCORED]),
        _AVERAGE,
        "first_year_offered",
        "last_year_offered",
        *zero(["temporally_invalid_semester_enrollments"]),
        *[f"{percent(f'{s}_enrollments', 'total_enrollments')} AS {rate}" for rate, s in rates.items()],
    )
