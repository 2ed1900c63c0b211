"""Scalar functions as Column builders; all of them run in the JVM and none raises on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import EARLY_DAYS, FOUNDED, NULL_TOKENS, RISK_HIGH, RISK_MID, SERIAL_HIGH, SERIAL_LOW


#: A time of day, which a date may end with; nothing else may.
_TIME = r"(?:[ T]\s*\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?\s*(?:[AaPp][Mm])?\s*(?:Z|[+-]\d{2}:?\d{2})?)?"
#: Spellings of dates, told by how they begin: that, the whole, and which of its parts are year, month and day.
_SPELLINGS = {
    "year_first": (r"^\d{4}[-./]", r"(\d{4})[-./](\d{1,2})[-./](\d{1,2})", "$1-$2-$3"),
    "year_last": (r"^\d{1,2}[-./]\d", r"(\d{1,2})[-./](\d{1,2})[-./](\d{4})", "$3-$1-$2"),
    "korean": (r"^\d{4}\s*년", r"(\d{4})\s*년\s*(\d{1,2})\s*월\s*(\d{1,2})\s*일", "$1-$2-$3"),
    "month_name": (r"^[A-Za-z]{3}", r"([A-Za-z]{3})[A-Za-z]*\.?\s+(\d{1,2}),?\s+(\d{4})", "$3-$1-$2"),
    "day_name": (r"^\d{1,2}[\s-]+[A-Za-z]", r"(\d{1,2})[\s-]+([A-Za-z]{3})[A-Za-z]*\.?[\s-]+(\d{4})", "$3-$2-$1"),
}
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise(c) -> Column:
    """Null to the empty text; white space (wide blanks too) trimmed and collapsed to one blank."""
    return F.trim(F.regexp_replace(F.coalesce(_col(c), F.lit("")), r"(?U)\s+", " "))


def normalise_light(c) -> Column:
    """Line breaks to blanks, then trimmed; inner blanks stay, null stays null."""
    return F.regexp_replace(F.regexp_replace(_col(c), r"[\r\n]", " "), r"(?U)^\s+|\s+$", "")


def key_of(c) -> Column:
    """Comparable form of headers and names: no white space, brackets or separators, lower case."""
    return F.lower(F.regexp_replace(normalise(c), r"(?U)[\s()\[\]{}_:\-]", ""))


def person_name(c) -> Column:
    """Wide blanks to plain ones, trimmed; null stays null."""
    return F.regexp_replace(F.translate(_col(c), "　", " "), r"(?U)^\s+|\s+$", "")


def null_tokens(c) -> Column:
    return F.when(_col(c).isin(NULL_TOKENS), F.lit(None)).otherwise(_col(c))


def emp_id(c) -> Column:
    """A trailing .0 of a number read as text goes; inner ones stay."""
    return null_tokens(F.regexp_replace(normalise(c), r"\.0$", ""))


def clean_text(c) -> Column:
    return null_tokens(normalise(c))


def date_spelling(c) -> Column:
    """How a date is spelled, by its beginning: eight (digits), serial, or one of the others; null if it is like none."""
    t = F.trim(_col(c).cast("string"))
    out = F.when(t.rlike(r"^\d{8}(\.0)?$"), "eight").when(t.rlike(r"^\d{1,9}(\.\d*)?$"), "serial")
    for name, (begin, _, _) in _SPELLINGS.items():
        out = out.when(t.rlike(begin), name)
    return out


def year_last_parts(c) -> tuple[Column, Column]:
    """First and second number of dates like 1/2/2024, else null."""
    t = F.trim(_col(c).cast("string"))
    return tuple(F.when(t.rlike(_SPELLINGS["year_last"][0]), F.regexp_extract(t, r"^(\d{1,2})[-./](\d{1,2})[-./]", i)).try_cast("int") for i in (1, 2))


def to_date(c, day_first: Column | bool = False) -> Column:
    """Dates of many spellings: yyyyMMdd, serial days (with a time of day or without) from 1899-12-30, year-month-day with -, . or / or in Korean,
    month/day/year (day/month/year where day_first says so), and months by English name before or after the day. All may end with a time of day. Else null; so is the epoch day.

    A value is parsed in the one spelling that its beginning tells."""
    t = F.trim(_col(c).cast("string"))
    number = t.try_cast("double")
    serial = F.when((number >= SERIAL_LOW) & (number <= SERIAL_HIGH), F.date_add(F.lit("1899-12-30").cast("date"), F.floor(number).cast("int")))
    found = F.when(t.rlike(r"^\d{8}(\.0)?$"), F.regexp_replace(t, r"^(\d{4})(\d{2})(\d{2}).*$", "$1-$2-$3").try_cast("date"))
    found = found.when(t.rlike(r"^\d{1,9}(\.\d*)?$"), serial)
    months = F.create_map(*[F.lit(x) for i in range(12) for x in (_MONTHS[3 * i : 3 * i + 3], f"-{i + 1}-")])
    plain = isinstance(day_first, bool)
    for name, (_, whole, order) in _SPELLINGS.items():
        whole = f"^{whole}{_TIME}$"
        read = lambda o, w=whole: F.regexp_replace(t, w, o)
        if name.endswith("_name"):
            year, month, day = (F.regexp_extract(t, whole, int(x[1])) for x in order.split("-"))
            text = F.concat(year, F.try_element_at(months, F.lower(month)), day)
        elif name == "year_last" and not plain:
            text = F.when(F.coalesce(day_first, F.lit(False)), read("$3-$2-$1")).otherwise(read(order))
        else:
            text = read("$3-$2-$1" if name == "year_last" and day_first else order)
        found = found.when(t.rlike(whole), text.try_cast("date"))
    return F.nullif(found, F.lit("1970-01-01").cast("date"))


def month_of(c) -> Column:
    """First day of the month."""
    return F.trunc(_col(c), "MM")


def since_founding(c, floor: str = FOUNDED) -> Column:
    """Dates before the company's founding are taken for errors."""
    return F.when(_col(c) >= F.lit(floor).cast("date"), _col(c))


def dotted_date(c, floor: str = FOUNDED) -> Column:
    return since_founding(F.regexp_replace(F.trim(_col(c).cast("string")), r"\.", "-").try_cast("date"), floor)


def tenure_days(joined, left) -> Column:
    return F.datediff(_col(left), _col(joined))


def is_early(days, limit: int = EARLY_DAYS) -> Column:
    return _col(days).between(0, limit)


def year_in(*names) -> Column:
    """The first year from 1900 to 2099 in the first text that has one."""
    return F.coalesce(*[F.nullif(F.regexp_extract(_col(n), r"((?:19|20)\d{2})", 1), F.lit("")).cast("int") for n in names])


def digits_year(c) -> Column:
    return F.regexp_replace(_col(c), r"\D", "").try_cast("int")


def date_in(c) -> Column:
    """The first eight digits of a name."""
    return F.nullif(F.regexp_extract(_col(c), r"(\d{8})", 1), F.lit(""))


def split_org(c) -> tuple[Column, Column]:
    """Division and team of texts like division-team."""
    parts = F.split(_col(c), "[-·]", 2)
    return F.trim(F.try_element_at(parts, F.lit(1))), F.trim(F.try_element_at(parts, F.lit(2)))


def number(c) -> Column:
    return _col(c).try_cast("double")


def percent(part, whole) -> Column:
    """100 part / whole; 0 where the whole is null, 0 or less."""
    return F.when(_col(whole) > 0, _col(part) / _col(whole) * 100.0).otherwise(F.lit(0.0))


def one_place(c) -> Column:
    """Rounded to one place, halves to even."""
    return F.bround(_col(c), 1)


def risk_level(score) -> Column:
    return F.when(_col(score) >= RISK_HIGH, "high").when(_col(score) >= RISK_MID, "mid").otherwise("low")


def contains_any(c, words: list[str]) -> Column:
    text = F.lower(_col(c))
    hit = F.lit(False)
    for w in words:
        hit = hit | text.contains(w.lower())
    return hit


def file_name(path) -> Column:
    return F.regexp_extract(_col(path), r"([^/\\]*)$", 1)


def file_suffix(path) -> Column:
    return F.lower(F.regexp_extract(_col(path), r"(\.[^./\\]*)$", 1))


def parent_folder(path) -> Column:
    return F.regexp_extract(_col(path), r"([^/\\]*)[/\\][^/\\]*$", 1)


def content_sha1(content, first: int) -> Column:
    return F.sha1(F.substring(_col(content), 1, first))
