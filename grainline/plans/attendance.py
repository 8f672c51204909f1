"""Attendance report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainline.operators import top_k, with_run_length

KEY = "employee_id"


def attendance_streaks(attendance: DataFrame, employees: DataFrame, top: int = 5) -> DataFrame:
    """Employees with the longest run of consecutive present days.

    A day counts once, however often it was recorded.
    """
    days = (
        attendance.filter(F.col("attendance_status") == "Present")
        .select(KEY, "attendance_date")
        .distinct()
    )
    runs = with_run_length(days, KEY, "attendance_date", mode="activity", unit="day")
    people = runs.groupBy(KEY).agg(
        F.count("*").alias("total_present_days"),
        F.max("run_length").alias("longest_present_streak"),
        F.max("attendance_date").alias("latest_attendance_date"),
    )
    named = people.join(employees.select(KEY, "employee_name", "department"), KEY)
    return top_k(named, "longest_present_streak", top, tie=KEY).select(
        KEY,
        "employee_name",
        "department",
        "total_present_days",
        "longest_present_streak",
        "latest_attendance_date",
    )
