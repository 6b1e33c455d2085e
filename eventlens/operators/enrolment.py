"""Joins and aggregates over courses, students and their scores.

Inputs have the columns ``course(num, course)``, ``student(id, name, ...)``
and ``scores(id, num, score)``; each function uses only the columns it
needs, so scans are pruned to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attended(scores: DataFrame, courses: DataFrame) -> DataFrame:
    """(id, course): a row per score, with its course's name."""
    return scores.select("id", "num").join(courses.select("num", "course"), "num").select("id", "course")


def attendance_names(attendance: DataFrame, students: DataFrame) -> DataFrame:
    """(name, course): attendance with the student's name instead of the id."""
    return attendance.join(students.select("id", "name"), "id").select("name", "course")


def mean_scores(scores: DataFrame, only_course: int | None = None) -> DataFrame:
    """(num, mean_score) per course, or of one course; the restriction to one
    course reaches the scan."""
    rows = scores if only_course is None else scores.where(F.col("num") == only_course)
    return rows.groupBy("num").agg(F.avg("score").alias("mean_score"))


def mean_scores_by_name(scores: DataFrame, courses: DataFrame) -> DataFrame:
    """(course, mean_score) per course name.  Scores are summed per number
    before the join, so the join sees one row per course; names shared by
    several numbers are pooled."""
    sums = scores.groupBy("num").agg(F.sum("score").alias("total"), F.count("score").alias("n"))
    named = sums.join(courses.select("num", "course"), "num")
    return named.groupBy("course").agg((F.sum("total") / F.sum("n")).alias("mean_score"))


def best_score(scores: DataFrame, students: DataFrame, course: int) -> DataFrame:
    """(best_score) among known students in one course; no row without any."""
    rows = scores.where(F.col("num") == course).join(students.select("id"), "id", "left_semi")
    return rows.agg(F.max("score").alias("best_score")).where("best_score is not null")


def course_sizes(scores: DataFrame) -> DataFrame:
    """(num, n_scores): scores with a student per course."""
    return scores.groupBy("num").agg(F.count("id").alias("n_scores"))


def students_with_courses(scores: DataFrame, at_least: int) -> DataFrame:
    """(id, n_courses) of students with that many different courses."""
    return (scores.groupBy("id").agg(F.countDistinct("num").alias("n_courses"))
            .where(F.col("n_courses") >= at_least))
