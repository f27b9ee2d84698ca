"""Skill-level classifier golden cases (FIXTURES §3) and Q19/Q20."""

from __future__ import annotations

from pyspark.sql import functions as F

from courtgrid.functions import rules as R

CASES = [
    ("Advanced Intermediate", "High Intermediate"),
    ("Advanced Beginner 201", "Advanced Beginner"),
    ("Advanced 401", "Advanced"),
    ("3.75", "High Intermediate"),
    ("All Levels Beginner", "All Levels"),
    ("", "All Levels"),
    (None, "All Levels"),
    ("   ", "All Levels"),
    ("Beginner 101", "Beginner"),
    ("Intermediate Drill", "Intermediate"),
    ("Try-It Night", "Beginner"),
    ("Live Match Play", "Advanced"),
    ("Paddle Battle", "Intermediate"),
    ("Social Mixer", "All Levels"),
    ("Exp Beg Ladder", "Advanced Beginner"),
    ("Advanced Intermediates", "All Levels"),
    ("3.0+ Night", "Advanced Beginner"),
    ("4.0+ Round Robin", "Advanced"),
    ("high intermediate clinic", "High Intermediate"),
]


def test_skill_levels(spark):
    df = spark.createDataFrame([(t,) for t, _ in CASES], "t string")
    got = [r[0] for r in df.select(R.skill_level(F.col("t"))).collect()]
    assert got == [want for _, want in CASES]


def test_unicode_space_q20(spark):
    # "Exp<NBSP>Beg": Python's \s matches the no-break space, so must Spark's.
    df = spark.createDataFrame([("Exp Beg",)], "t string")
    assert df.select(R.skill_level(F.col("t"))).first()[0] == "Advanced Beginner"
    plain = df.select(R.skill_level(F.col("t"), flags="(?i)")).first()[0]
    assert plain == "All Levels"


def test_no_python_udf_in_plan(spark):
    df = spark.createDataFrame([("Beginner",)], "t string").select(R.skill_level(F.col("t")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
