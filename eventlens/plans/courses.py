"""Course, student and score queries over stand-ins: suppliers are courses,
customers students, and a line item a score of its order's customer in its
supplier's course."""

from __future__ import annotations

from ..operators import enrolment
from ..sources import stand_ins, tables
from .registry import query

COURSE = 1
MIN_COURSES = 20

SCORES = "lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey"
MEAN = "avg(CAST(trunc(l_quantity) AS INTEGER)) AS mean_score"
NAMES = f"SELECT c_name AS name, s_name AS course FROM {SCORES} JOIN supplier ON s_suppkey = l_suppkey JOIN customer ON c_custkey = o_custkey"


@query("course_join", f"SELECT CAST(o_custkey AS INTEGER) AS id, s_name AS course FROM {SCORES} JOIN supplier ON s_suppkey = l_suppkey")
def course_join(spark, sf_dir):
    """JN1."""
    return enrolment.attended(stand_ins.student_course(spark, sf_dir), stand_ins.course(spark, sf_dir))


@query("course_join_subquery", NAMES)
def course_join_subquery(spark, sf_dir):
    """JN3: the attendance joined with the students in one plan."""
    return enrolment.attendance_names(course_join(spark, sf_dir), stand_ins.student(spark, sf_dir))


@query("course_join_ctas", NAMES)
def course_join_ctas(spark, sf_dir):
    """SRC6 + JN2 + SNK4: the three tables as comma-delimited text with
    declared schemas; the attendance is materialised as a table below the
    shared folder, then joined with the students."""
    given = stand_ins.course_tables(spark, sf_dir, delimited=True)
    kept = tables.create_table_as_select(
        spark, "attendance", enrolment.attended(given["studentcourse"], given["course"]))
    return enrolment.attendance_names(kept, given["student"])


@query("course_avg_one", f"SELECT CAST(l_suppkey AS INTEGER) AS num, {MEAN} FROM lineitem WHERE l_suppkey = {COURSE} GROUP BY 1")
def course_avg_one(spark, sf_dir):
    """AGG8 + FLT5."""
    return enrolment.mean_scores(stand_ins.scores(spark, sf_dir), only_course=COURSE)


@query("course_avg", f"SELECT CAST(l_suppkey AS INTEGER) AS num, {MEAN} FROM lineitem GROUP BY 1")
def course_avg(spark, sf_dir):
    """AGG9."""
    return enrolment.mean_scores(stand_ins.scores(spark, sf_dir))


@query("course_avg_by_name", f"SELECT s_name AS course, {MEAN} FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1")
def course_avg_by_name(spark, sf_dir):
    """AGG10 + JN4."""
    return enrolment.mean_scores_by_name(stand_ins.scores(spark, sf_dir), stand_ins.course(spark, sf_dir))


@query("course_max_one", f"SELECT max(CAST(trunc(l_quantity) AS INTEGER)) AS best_score FROM {SCORES} WHERE l_suppkey = {COURSE} HAVING count(*) > 0")
def course_max_one(spark, sf_dir):
    """AGG11 + FLT5."""
    return enrolment.best_score(stand_ins.student_course(spark, sf_dir), stand_ins.student(spark, sf_dir), COURSE)


@query("course_count", f"SELECT CAST(l_suppkey AS INTEGER) AS num, count(*) AS n_scores FROM {SCORES} GROUP BY 1")
def course_count(spark, sf_dir):
    """AGG12."""
    return enrolment.course_sizes(stand_ins.student_course(spark, sf_dir))


@query("student_min_courses", f"SELECT CAST(o_custkey AS INTEGER) AS id, count(DISTINCT l_suppkey) AS n_courses FROM {SCORES} GROUP BY 1 HAVING count(DISTINCT l_suppkey) >= {MIN_COURSES}")
def student_min_courses(spark, sf_dir):
    """AGG13: students with at least ``MIN_COURSES`` different courses."""
    return enrolment.students_with_courses(stand_ins.student_course(spark, sf_dir), MIN_COURSES)
