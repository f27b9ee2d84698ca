"""Ordered regex rule classifier: skill level from an event name.

The rule list is data; :func:`skill_level` compiles it into one ``CASE``
expression of ``rlike`` tests, so classification is a column expression
inside whole-stage codegen (no UDF, no per-row update pass, M12).

Every pattern runs with ``(?iU)``: case-insensitive, and ``\\b``/``\\s``
with Unicode meaning as in Python's ``re`` (Q20).  Guards and order follow
the code path of the reference, not its unused ``high_intermediate`` list
(Q19).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import scalars as S

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's (pattern lists, labels).
# ---------------------------------------------------------------------------
ALL_LEVELS = "All Levels"
HIGH_INTERMEDIATE = "High Intermediate"
ADVANCED_BEGINNER = "Advanced Beginner"
ADVANCED = "Advanced"
INTERMEDIATE = "Intermediate"
BEGINNER = "Beginner"

SKILL_PATTERNS = {
    "advanced_beginner": [
        r"\b201\b",
        r"Advanced\s*Beginner",
        r"\b3\.0\+?\b",
        r"Experienced\s*Beginner",
        r"\bAdv(?:anced)?\s*Beg(?:inner)?\b",
        r"Experienced\s+Beg",
        r"\bExp\s*Beg\b",
    ],
    "beginner": [
        r"\b101\b",
        r"\bIntro",
        r"\bBeginner\b",
        r"\b2\.0\b",
        r"\b2\.25\b",
        r"\b2\.5\b",
        r"\b2\.75\b",
        r"Try[ -]?[Ii]t",
        r"Try-?It",
    ],
    "intermediate": [
        r"\b301\b",
        r"\b302\b",
        r"\bIntermediate\b",
        r"\b3\.25\+?\b",
        r"\b3\.5\+?\b",
        r"Paddle\s*Battle",
        r"\bDrill\s*Hour\b",
        r"Fixed\s*Partner",
    ],
    "advanced": [
        r"\b401\b",
        r"\b501\b",
        r"\bAdvanced\b",
        r"\b4\.0\+?\b",
        r"\b4\.25\+?\b",
        r"\b4\.5\+?\b",
        r"\b5\.0\b",
        r"\bExpert\b",
        r"Live\s*Match\s*Play",
    ],
}
ALL_LEVELS_RE = r"\bAll\s+Levels\b"
HIGH_INTERMEDIATE_RE = r"\b(High|Advanced)\s+Intermediate\b"
RATING_375_RE = r"\b3\.75\+?\b"
ADV_EXP_BEGINNER_RE = r"\b(Advanced|Experienced)\s+Beginner\b"
ADV_INTERMEDIATE_LOOSE_RE = r"Advanced\s+Intermediate"
ADV_INT_OR_BEG_LOOSE_RE = r"Advanced\s+(Intermediate|Beginner)"

# Ordered rules: (label, patterns that must match (any), guard patterns that must not match).
RULES = [
    (ALL_LEVELS, [ALL_LEVELS_RE], []),
    (HIGH_INTERMEDIATE, [HIGH_INTERMEDIATE_RE], []),
    (HIGH_INTERMEDIATE, [RATING_375_RE], []),
    (ADVANCED_BEGINNER, [ADV_EXP_BEGINNER_RE], []),
    (ADVANCED_BEGINNER, SKILL_PATTERNS["advanced_beginner"], [ADV_INTERMEDIATE_LOOSE_RE]),
    (ADVANCED, SKILL_PATTERNS["advanced"], [ADV_INT_OR_BEG_LOOSE_RE]),
    (INTERMEDIATE, SKILL_PATTERNS["intermediate"], [HIGH_INTERMEDIATE_RE]),
    (BEGINNER, SKILL_PATTERNS["beginner"], [ADV_EXP_BEGINNER_RE]),
]


def _any(patterns: list[str], flags: str) -> str:
    return flags + "|".join(f"(?:{p})" for p in patterns)


def skill_level(name, flags: str = "(?iU)") -> Column:
    """Skill level of an event name; blank or unmatched -> 'All Levels'."""
    text = S.py_strip(F.coalesce(name if not isinstance(name, str) else F.col(name), F.lit("")))
    expr = F.when(text == "", F.lit(ALL_LEVELS))
    for label, pats, guards in RULES:
        cond = text.rlike(_any(pats, flags))
        for g in guards:
            cond = cond & ~text.rlike(flags + g)
        expr = expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(ALL_LEVELS))


def skill_level_sql(text_sql: str) -> str:
    """The same rule list as DuckDB SQL (RE2, ASCII word boundaries), for the
    oracle of ASCII titles."""
    t = f"trim(coalesce({text_sql}, ''))"

    def m(p):
        p = p.replace("'", "''")
        return f"regexp_matches({t}, '(?i){p}')"

    parts = [f"WHEN {t} = '' THEN '{ALL_LEVELS}'"]
    for label, pats, guards in RULES:
        cond = "(" + " OR ".join(m(p) for p in pats) + ")"
        for g in guards:
            cond += f" AND NOT {m(g)}"
        parts.append(f"WHEN {cond} THEN '{label}'")
    return "CASE " + " ".join(parts) + f" ELSE '{ALL_LEVELS}' END"
