"""The student table: cleaning recipe and validation rules."""

from __future__ import annotations

from ..functions import exprs
from ..operators.clean import CleanPlan
from ..operators.profile import Rule, member_rule, number_rule, present_rules
from ..sources.records import CLEANED_COLUMNS, CLEANED_NUMBERS

DOMAINS = ("ML", "Web", "Electronics", "Mechanical")


def student_plan() -> CleanPlan:
    return CleanPlan(
        rules={
            "domain": exprs.canonical("domain"),
            "attendance_percent": exprs.percent("attendance_percent"),
            "score": exprs.word_number("score"),
            "study_hours": exprs.word_number("study_hours"),
            "height_cm": exprs.length_cm("height"),
            "weight_kg": exprs.mass_kg("weight"),
            "submitted": exprs.yes_no("submitted"),
        },
        fills={**{c: "median" for c in CLEANED_NUMBERS}, "domain": "mode"},
        drop=("height", "weight"),
        identity=("name", "student_id"),
        order=CLEANED_COLUMNS,
    )


def student_rules() -> list[Rule]:
    """Row rules; uniqueness of ``student_id`` is checked beside them."""
    return [
        number_rule("attendance_percent", 0, 100),
        number_rule("score", 0),
        number_rule("study_hours", 0),
        number_rule("height_cm", 0, strict=True),
        number_rule("weight_kg", 0, strict=True),
        member_rule("submitted", ("yes", "no")),
        member_rule("domain", DOMAINS),
        *present_rules(CLEANED_COLUMNS),
    ]
