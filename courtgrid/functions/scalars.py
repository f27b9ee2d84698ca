"""Scalar column functions.

Every function maps ``Column -> Column`` and is built only from Spark's
built-in expressions, so it stays inside whole-stage code generation and
needs no Python worker.  Two families exist where the reference has two
variants with different results (quirk Q11): ``*_ingest`` follows the
Python ingestion rules, ``*_model`` follows the SQL model macros.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
# Marker for null parts of a surrogate key (public dbt_utils convention).
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
# Separator of md5 natural keys in the staging and mart models.
KEY_SEPARATOR = "||"
# Fallback prefix for a court without a name.
COURT_FALLBACK_PREFIX = "Court "
# Default facility zone of the peak labelling model.
DEFAULT_FACILITY_ZONE = "America/New_York"
# Zone of naive system-A event / reservation times.
SYSTEM_A_NAIVE_ZONE = "America/New_York"
# Duration display texts, minutes -> text.
DURATION_TEXTS = [
    (30, "30 minutes"),
    (60, "1 hour"),
    (90, "1.5 hours"),
    (120, "2 hours"),
    (150, "2.5 hours"),
    (180, "3 hours"),
]
# Event type mapping of the events mart: target -> source types (upper-cased).
EVENT_TYPE_GROUPS = [
    ("Class", ["ADULT_CLASS", "PKLYN ACADEMY", "PKLYN SPECIAL EVENTS", "CLASSES"]),
    ("Open Play", ["OPEN_PLAY", "DROP-IN", "DROPIN"]),
    ("Compete", ["COMPETE", "LEAGUE NIGHT", "TOURNAMENT"]),
]
# Event types removed from the events mart (upper-cased, trimmed).
EXCLUDED_EVENT_TYPES = ["PARTY", "PRIVATE EVENT", "PRIVATEEVENT"]
# Display names of the two booking systems in the client dimension.
SYSTEM_DISPLAY_NAMES = [("courtreserve", "CourtReserve"), ("podplay", "Podplay")]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------------------
# Whitespace helpers (Q21): Python strip() cuts any Unicode white space,
# SQL trim() cuts spaces only.
# ---------------------------------------------------------------------------
# Python's white space, derived by rule from ``str.isspace`` (not a list).
PY_WHITESPACE = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())


def py_strip(x) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode white space
    (Spark's ``btrim`` with Python's white-space set; no regex)."""
    return F.btrim(_c(x), F.lit(PY_WHITESPACE))


def blank_to_null(x) -> Column:
    """``nullif(trim(x), '')`` the SQL way (spaces only)."""
    c = _c(x)
    return F.when(F.trim(c) == "", F.lit(None).cast("string")).otherwise(c)


def truthy_or(*cols) -> Column:
    """Python ``a or b or ...`` over strings: '' and null both fall through."""
    parts = [F.when(_c(c) != "", _c(c)) for c in cols[:-1]]
    return F.coalesce(*parts, _c(cols[-1]))


def nonzero_or(a, b) -> Column:
    """Python ``a or b`` over numbers: 0 and null both fall through."""
    return F.coalesce(F.nullif(_c(a), F.lit(0)), _c(b))


# ---------------------------------------------------------------------------
# C1 / C2 e-mail
# ---------------------------------------------------------------------------
def normalize_email_ingest(x) -> Column:
    """Strip, lower; exactly one '@' with both sides non-empty, else null."""
    e = F.lower(py_strip(_c(x)))
    parts = F.split(e, "@", -1)
    ok = (F.size(parts) == 2) & (F.try_element_at(parts, F.lit(1)) != "") & (F.try_element_at(parts, F.lit(2)) != "")
    return F.when(_c(x).isNotNull() & (e != "") & ok, e)


def normalize_email_model(x) -> Column:
    """SQL macro; position tests on the untrimmed value, several '@' allowed."""
    c = _c(x)
    at = F.instr(c, "@")
    return (
        F.when(c.isNull() | (F.trim(c) == ""), F.lit(None).cast("string"))
        .when(~c.like("%@%"), F.lit(None).cast("string"))
        .when(at == 1, F.lit(None).cast("string"))
        .when(at == F.length(c), F.lit(None).cast("string"))
        .otherwise(F.lower(F.trim(c)))
    )


# ---------------------------------------------------------------------------
# C3 / C4 phone
# ---------------------------------------------------------------------------
def normalize_phone_ingest(x) -> Column:
    """The Python ingestion rules, in their order."""
    raw = _c(x)
    s = py_strip(raw)
    clean = F.regexp_replace(s, r"(?U)[\s\-().]", "")
    digits = F.regexp_replace(clean, r"(?U)\D", "")
    n = F.length(digits)
    null = F.lit(None).cast("string")
    return (
        F.when(raw.isNull() | (raw == "") | (s == ""), null)
        .when(clean.startswith("+1") & (F.length(clean) == 12), clean)
        .when(clean.startswith("+") & ~clean.startswith("+1"), clean)
        .when(n == 0, null)
        .when((n == 11) & digits.startswith("1"), F.concat(F.lit("+"), digits))
        .when(n == 10, F.concat(F.lit("+1"), digits))
        .when(digits.startswith("1") & (n > 11), F.concat(F.lit("+"), F.substring(digits, 1, 11)))
        .when(n == 11, F.concat(F.lit("+"), digits))
        .when(n < 10, null)
        .otherwise(F.concat(F.lit("+1"), F.substring(digits, -10, 10)))
    )


def normalize_phone_model(x) -> Column:
    """C4: the SQL macro's seven ordered rules (formatted '+1 (..)' kept as typed)."""
    c = _c(x)
    d = F.regexp_replace(c, "[^0-9]", "")
    n = F.length(d)
    null = F.lit(None).cast("string")
    return (
        F.when(c.isNull() | (F.trim(c) == ""), null)
        .when(c.like("+%") & ~c.like("+1%"), c)
        .when(c.like("+1%") & (n == 11) & d.like("1%"), c)
        .when((n == 11) & d.like("1%"), F.concat(F.lit("+"), d))
        .when(n == 10, F.concat(F.lit("+1"), d))
        .when(n > 10, F.concat(F.lit("+1"), F.substring(d, -10, 10)))
        .otherwise(null)
    )


# ---------------------------------------------------------------------------
# C5–C9 time parsing and zones
# ---------------------------------------------------------------------------
_ISO_DATE = r"\d{4}-\d{2}-\d{2}"
_ISO_TIME = r"\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?"
_ISO_OFFSET = r"[+-]\d{2}(:?\d{2})?"
ISO_ANY_RE = rf"^{_ISO_DATE}([T ]{_ISO_TIME}({_ISO_OFFSET}|Z)?)?$"
# the form that Spark's cast reads as it stands: extended, at most six digits of a second
ISO_PLAIN_RE = rf"^{_ISO_DATE}([T ]\d{{2}}:\d{{2}}(:\d{{2}}(\.\d{{1,6}})?)?({_ISO_OFFSET}|Z)?)?$"


def _extended(x: Column) -> Column:
    """ISO text in the extended form: the basic form (20250106T100000Z) with its
    separators put in, fractions cut to six digits."""
    s = F.regexp_replace(x, r"^(\d{4})(\d{2})(\d{2})(?=$|[T ])", "$1-$2-$3")
    s = F.regexp_replace(s, r"^(.{10}[T ]\d{2})(\d{2})(\d{2})(?![\d:])", "$1:$2:$3")
    s = F.regexp_replace(s, r"^(.{10}[T ]\d{2})(\d{2})(?![\d:])", "$1:$2")
    return F.regexp_replace(s, r"[.,](\d{1,6})\d*", ".$1")


def parse_iso_utc(x, naive_zone="UTC") -> Column:
    """ISO text -> UTC instant; 'Z' accepted; naive text is read in
    ``naive_zone`` (a zone name or a zone column); unparsable text -> null.

    One regex checks the plain shape, which most texts have; only other texts are
    rewritten, then checked against all of Python's ``fromisoformat`` forms.  The
    offset test is plain string work on the text as it came (a date in either form ends
    before its eleventh character, an offset starts after it), so no regex is run for it,
    and Spark's own cast parses 'Z', '+05', '+0530' and '+05:30'."""
    c = _c(x)
    zone = F.lit(naive_zone) if isinstance(naive_zone, str) else naive_zone
    rewritten = _extended(c)
    s = F.when(c.rlike(ISO_PLAIN_RE), c).when(rewritten.rlike(ISO_ANY_RE), rewritten)
    ts = s.try_cast("timestamp")  # session zone is UTC: a naive wall clock is kept as is
    if isinstance(naive_zone, str) and naive_zone == "UTC":
        return ts
    tail = F.substr(c, F.lit(11))
    has_offset = c.endswith("Z") | (F.instr(tail, "+") > 0) | (F.instr(tail, "-") > 0)
    return F.when(has_offset, ts).otherwise(F.to_utc_timestamp(ts, zone))


def parse_event_time(x) -> Column:
    """System-A event/reservation time, naive = New York."""
    return parse_iso_utc(x, SYSTEM_A_NAIVE_ZONE)


def parse_iso_date(x) -> Column:
    """ISO date text -> DATE, null on error."""
    c = _c(x)
    return F.when(c.rlike(rf"^{_ISO_DATE}$"), c.try_cast("date"))


def weekday_name(ts) -> Column:
    """Full English weekday name of an instant (UTC)."""
    return F.date_format(_c(ts), "EEEE")


def resolve_zone(known_zones: Iterable[str], *candidates) -> Column:
    """First candidate that names a known zone, else 'UTC'.

    Spark raises on an unknown zone, so every candidate is tested against
    ``known_zones`` first (a fixed list: the zone database, a few hundred
    names).
    """
    known = sorted(set(known_zones))
    picks = [F.when(_c(c).isin(known), _c(c)) for c in candidates]
    return F.coalesce(*picks, F.lit("UTC"))


def known_zone_names(spark) -> list[str]:
    """Zone names both the JVM and Python's zone database know (Python's
    alone when the JVM is not reachable, e.g. over Spark Connect)."""
    import zoneinfo

    try:
        py_ids = set(zoneinfo.available_timezones())
    except Exception:  # pragma: no cover - no tz database
        py_ids = set()
    try:
        jvm_ids = set(spark.sparkContext._jvm.java.time.ZoneId.getAvailableZoneIds())
    except Exception:  # pragma: no cover - Spark Connect
        jvm_ids = py_ids
    return sorted(((jvm_ids & py_ids) if py_ids else jvm_ids) | {"UTC"})


# ---------------------------------------------------------------------------
# C10–C15 keys and display texts
# ---------------------------------------------------------------------------
def pg_timestamptz_text(ts) -> Column:
    """PostgreSQL text form of a UTC timestamptz: '2025-01-01 17:00:00+00',
    fractional seconds printed without trailing zeros."""
    c = _c(ts)
    micros = F.unix_micros(c) % 1000000
    frac = F.when(micros == 0, F.lit("")).otherwise(
        F.concat(F.lit("."), F.regexp_replace(F.lpad(micros.cast("string"), 6, "0"), "0+$", ""))
    )
    return F.when(c.isNotNull(), F.concat(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), frac, F.lit("+00")))


def md5_key(*parts) -> Column:
    """``md5(concat_ws('||', ...))``; null parts are skipped like in SQL."""
    return F.md5(F.concat_ws(KEY_SEPARATOR, *[_c(p) for p in parts]))


def surrogate_key(*parts) -> Column:
    """C11: md5 of the text forms joined by '-', null -> fixed marker.

    Timestamps are rendered in PostgreSQL's text form so keys are stable
    across engines.
    """
    texts = []
    for p in parts:
        texts.append(F.coalesce(_c(p), F.lit(SURROGATE_NULL)))
    return F.md5(F.concat_ws("-", *texts))


def surrogate_key_cols(df, names: list[str]) -> Column:
    """C11 with timestamp parts rendered by :func:`pg_timestamptz_text`."""
    types = dict(df.dtypes)
    parts = []
    for n in names:
        if types[n] in ("timestamp", "timestamp_ntz"):
            parts.append(pg_timestamptz_text(F.col(n).cast("timestamp")))
        else:
            parts.append(F.col(n).cast("string"))
    return surrogate_key(*parts)


def time_label(ts, zone: str = "UTC") -> Column:
    """``to_char(ts, 'FMHH12 AM')`` or ``'FMHH12:MI AM'`` when minutes != 0."""
    local = _c(ts) if zone == "UTC" else F.from_utc_timestamp(_c(ts), zone)
    return F.when(F.minute(local) == 0, F.date_format(local, "h a")).otherwise(
        F.date_format(local, "h:mm a")
    )


def court_display_name(name, court_id) -> Column:
    """Court name, else 'Court ' || id."""
    return F.coalesce(_c(name), F.concat(F.lit(COURT_FALLBACK_PREFIX), _c(court_id).cast("string")))


# ---------------------------------------------------------------------------
# C16–C21 time arithmetic
# ---------------------------------------------------------------------------
def minutes_between(start, end) -> Column:
    """Exact minutes between two instants (double)."""
    return (F.unix_micros(_c(end)) - F.unix_micros(_c(start))) / F.lit(60_000_000.0)


def rounded_minutes(start, end) -> Column:
    """``(extract(epoch from end - start) / 60)::integer`` (half away from 0)."""
    return F.round(minutes_between(start, end), 0).cast("bigint")


def dow_sunday0(ts) -> Column:
    """C17: day of week with 0 = Sunday."""
    return F.dayofweek(_c(ts)) - 1


def duration_text(start, end) -> Column:
    """Readable duration; exact minute values from the fixed table,
    otherwise 'n minutes' with n rounded."""
    m = minutes_between(start, end)
    expr = None
    for minutes, text in DURATION_TEXTS:
        cond = m == float(minutes)
        expr = F.when(cond, F.lit(text)) if expr is None else expr.when(cond, F.lit(text))
    return expr.otherwise(F.concat(F.round(m, 0).cast("bigint").cast("string"), F.lit(" minutes")))


def local_minute_of_day(ts, zone) -> Column:
    """Minutes since local midnight of an instant in a per-row zone."""
    local = F.from_utc_timestamp(_c(ts), _c(zone) if not isinstance(zone, str) else F.lit(zone))
    return F.hour(local) * 60 + F.minute(local)


def hhmm_to_minutes(x) -> Column:
    """'HH:mm' text -> minutes of day (null when malformed)."""
    c = _c(x)
    ok = c.rlike(r"^\d{1,2}:\d{2}(:\d{2})?$")
    parts = F.split(c, ":")
    return F.when(ok, F.try_element_at(parts, F.lit(1)).cast("int") * 60 + F.try_element_at(parts, F.lit(2)).cast("int"))


# ---------------------------------------------------------------------------
# C23, C24, C26, C28
# ---------------------------------------------------------------------------
def map_event_type(x) -> Column:
    """Event type mapping of the events mart; other types kept as-is."""
    key = F.upper(F.trim(_c(x)))
    expr = None
    for target, sources in EVENT_TYPE_GROUPS:
        cond = key.isin(sources)
        expr = F.when(cond, F.lit(target)) if expr is None else expr.when(cond, F.lit(target))
    return expr.otherwise(_c(x))


def keep_event_type(x) -> Column:
    """trimmed, case-folded NOT IN; a null type is dropped too."""
    return ~F.upper(F.trim(_c(x))).isin(EXCLUDED_EVENT_TYPES)


def is_full(num, cap) -> Column:
    """Registrants >= capacity, false when either is null."""
    return F.coalesce(_c(num) >= _c(cap), F.lit(False))


def safe_int(x) -> Column:
    """``int(x)`` in a try."""
    return _c(x).try_cast("bigint")


def safe_double(x) -> Column:
    """``float(x)`` in a try."""
    return _c(x).try_cast("double")


NULL_SENTINEL = "NULL"


def to_sentinel(x) -> Column:
    """``coalesce(period, 'NULL')``."""
    return F.coalesce(_c(x), F.lit(NULL_SENTINEL))


def from_sentinel(x) -> Column:
    """C28 back: 'NULL' -> null."""
    return F.when(_c(x) != NULL_SENTINEL, _c(x))


def system_display_name(x) -> Column:
    """Display name of a booking system code, else the code."""
    expr = None
    for code, name in SYSTEM_DISPLAY_NAMES:
        cond = _c(x) == code
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(_c(x))


def parse_courts_text(x) -> Column:
    """N17 (text form): 'Court #1, Court #2' -> trimmed, non-empty labels."""
    parts = F.transform(F.split(_c(x), ","), lambda p: py_strip(p))
    return F.coalesce(F.filter(parts, lambda p: p != ""), F.array().cast("array<string>"))


def parse_courts_array(x) -> Column:
    """N17 (array form): array of {Label} structs -> trimmed non-empty labels."""
    kept = F.filter(_c(x), lambda c: c["Label"].isNotNull() & (c["Label"] != ""))
    return F.coalesce(F.transform(kept, lambda c: py_strip(c["Label"])), F.array().cast("array<string>"))
