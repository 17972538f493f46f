"""Column rules that clean raw fields.

A rule that can fail returns (value, issue): the issue is a code where the raw value was there but couldn't be used, else null. Rules bind the text they look at several
times: written out, the fields of one spec become generated methods that are too long for the JVM to compile, which then run many times slower.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Ruled = tuple[Column, Column]

# Texts that stand for nothing.
SENTINELS = ["n/a", "na", "null", "none", "unknown", "undefined", "-", "--", "chưa có", "không có", "không"]
# The same as one pattern, which Python hands over in one call.
NAMES_OF_NOTHING = rf"\A(?:{'|'.join(map(re.escape, SENTINELS))})\z"
REFERENCE_PLACEHOLDERS = ["N/A", "NA", "NULL", "NONE"]
# Year typos and what they mean.
FOUR_DIGIT_YEARS = {"0222": "2022", "2222": "2022", "2202": "2022", "2223": "2023", "3023": "2023", "2206": "2026", "2044": "2024", "2035": "2025", "0202": "2022", "0201": "2021"}
THREE_DIGIT_YEARS = {"222": "2022", "202": "2022", "201": "2021", "203": "2023", "204": "2024", "205": "2025", "206": "2026"}
# Names of currencies.
CURRENCIES = {"VND": ["VND", "VNĐ", "ĐỒNG", "DONG"], "USD": ["USD", "DOLLAR"], "EUR": ["EUR", "EURO"]}

MONEY = "decimal(38,6)"
LOCAL_ZONE = "Asia/Ho_Chi_Minh"
#: What Python and most sources call white space at the ends of a field.
BLANKS = r"^[\s\x{A0}]+|[\s\x{A0}]+$"


def bind(c: Column, f) -> Column:
    """``f`` of ``c`` with ``c`` computed once, however often ``f`` names it."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, BLANKS, "")


def not_blank(c: Column) -> Column:
    """FLT-1."""
    return F.nullif(F.trim(c), F.lit("")).isNotNull()


def clean_text(c: Column, *, sentinels: bool = True) -> Column:
    """PRJ-1: trimmed text; blanks and sentinels are null."""
    # Lower-casing is dear: what is longer than all sentinels, or begins with a digit, is none.
    named = lambda t: (F.length(t) > max(map(len, SENTINELS))) | F.ascii(t).between(48, 57) | ~F.lower(t).rlike(NAMES_OF_NOTHING)
    return bind(strip(c.cast("string")), lambda t: F.when((t != "") & named(t) if sentinels else t != "", t))


def clean_reference(c: Column) -> Column:
    """PRJ-2."""
    return bind(clean_text(c), lambda t: F.when(~F.upper(t).isin(REFERENCE_PLACEHOLDERS), t))


def _ruled(text: Column, value: Callable[[Column], Column], issue: str) -> Ruled:
    """``value`` of a text, and ``issue`` where there is a text that isn't empty and has none."""
    both = bind(text, lambda t: F.when(t != "", bind(value(t), lambda v: F.struct(v.alias("value"), F.when(v.isNull(), issue).alias("issue")))))
    return both["value"], both["issue"]


def parse_money(c: Column) -> Ruled:
    """PRJ-3, PRJ-4: exact decimal text, also with an exponent, with at most six fractional digits under 1e32; never through a float."""

    def of(text: Column) -> Column:
        number = text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d{1,3})?$")
        power = F.coalesce(F.regexp_extract(text, r"[eE]([+-]?\d+)$", 1).try_cast("int"), F.lit(0))
        plain = F.regexp_replace(text, r"[eE].*$", "")
        digits = F.length(F.regexp_replace(F.split_part(plain, F.lit("."), F.lit(1)), r"^[+-]?0*", "")) + power
        scale = F.length(F.regexp_replace(F.split_part(plain, F.lit("."), F.lit(2)), r"0+$", "")) - power
        issue = F.when(~number, "invalid_money").when(scale > 6, "money_scale").otherwise("money_magnitude")
        any_ = bind(F.when(number & (digits <= 32) & (scale <= 6), text.try_cast(MONEY)), lambda v: F.struct(v.alias("value"), F.when(v.isNull(), issue).alias("issue")))
        # Most are short plain numbers, which fit whatever they are.
        short = F.struct(text.try_cast(MONEY).alias("value"), F.lit(None).cast("string").alias("issue"))
        return F.when(text == "", None).when(text.rlike(r"^[+-]?\d{1,32}(\.\d{1,6})?$"), short).when(text.isNotNull(), any_)

    both = bind(strip(c), of)
    return both["value"], both["issue"]


def repair_year(year: Column) -> Column:
    """PRJ-5: a year of three or four digits with a known typo, repaired."""
    table = F.create_map(*(F.lit(x) for pair in {**THREE_DIGIT_YEARS, **FOUR_DIGIT_YEARS}.items() for x in pair))
    # Rules for what the table doesn't have, in order: pattern, prefix of the repaired year, group that follows.
    rules = [(r"^20([1-9])$", "202"), (r"^30([0-9]{2})$", "20"), (r"^20([3-9])\1$", "202"), (r"^203([4-9])$", "202"), (r"^022([0-9])$", "202"), (r"^020([1-9])$", "202"), (r"^222([0-9])$", "202"), (r"^220([0-9])$", "202")]

    def ruled(y: Column) -> Column:
        out = y
        for pattern, prefix in reversed(rules):
            out = F.when(y.rlike(pattern), F.regexp_replace(y, pattern, f"{prefix}$1")).otherwise(out)
        return F.coalesce(F.try_element_at(table, y), out)

    return bind(year, lambda y: F.when(y.rlike("^20[0-2][0-9]$"), y).otherwise(ruled(y)))


def repair_date_year(text: Column, anchor: Column | None = None) -> Column:
    """PRJ-5, PRJ-6: date text with its year repaired; a year more than one after the anchor's becomes the anchor's."""

    def repaired(t: Column) -> Column:
        year = F.regexp_extract(t, r"^(.{3}(?=-.{5})|.{4}(?=-.{5}))", 1)
        of = F.substring(anchor.cast("string"), 1, 4).try_cast("int") if anchor is not None else None
        snap = (lambda y: y) if of is None else lambda y: F.when(y.try_cast("int") > of + 1, of.cast("string")).otherwise(y)
        return F.when(year == "", t).otherwise(F.concat(bind(repair_year(year), snap), F.substring(t, F.length(year) + 1, 1_000_000)))

    return bind(text, repaired)


def parse_date(c: Column, anchor: Column | None = None) -> Ruled:
    """PRJ-8: a date, cut at the first T, else blank."""
    cut = lambda t: F.when(t.contains("T"), F.substring_index(t, "T", 1)).otherwise(F.substring_index(t, " ", 1))
    value = lambda t: bind(repair_date_year(cut(t), anchor), lambda d: F.when(d.rlike(r"^\d{4}-\d{2}-\d{2}$"), d.try_cast("date")))
    return _ruled(clean_text(c), value, "invalid_date")


def date_repair(c: Column, anchor: Column | None = None) -> Column:
    """PRJ-15: the audit code of a repaired year, else null."""
    year = lambda x: F.split_part(x, F.lit("-"), F.lit(1))
    told = lambda t: bind(repair_date_year(t, anchor), lambda d: F.when(d != t, F.concat(F.lit("date_year_repaired_"), year(t), F.lit("_to_"), year(d))))
    return bind(clean_text(c), lambda t: F.when(t.isNotNull(), told(t)))


def parse_instant(c: Column, anchor: Column | None = None, zone: str = LOCAL_ZONE) -> Ruled:
    """PRJ-7: an instant; text without an offset is in the local zone. The session's zone must be UTC."""
    zoned = lambda d: F.when(d.rlike(r"(?:Z|[+-]\d{2}:?\d{2})$"), d.try_cast("timestamp")).otherwise(F.to_utc_timestamp(d.try_cast("timestamp"), zone))
    return _ruled(clean_text(c), lambda t: bind(repair_date_year(t, anchor), zoned), "invalid_datetime")


def bounded_date(c: Column, low: int = 2010, high: int = 2030) -> Column:
    """PRJ-9."""
    value, _ = parse_date(c)
    return F.when(F.year(value).between(low, high), value)


def parse_boolean(c: Column) -> Ruled:
    """PRJ-10: strict tokens, three states."""
    value = lambda t: F.when(t.isin("true", "t", "1", "yes", "y"), True).when(t.isin("false", "f", "0", "no", "n"), False)
    return _ruled(F.lower(strip(c.cast("string"))), value, "invalid_boolean")


def clean_pipe_code(c: Column) -> Column:
    """PRJ-11."""
    return bind(strip(F.regexp_replace(clean_text(c), r"^\|+|\|+$", "")), lambda t: F.when(t != "", t))


def clean_currency(c: Column) -> Column:
    """PRJ-12."""

    def of(upper: Column) -> Column:
        out = upper
        for code, names in CURRENCIES.items():
            out = F.when(upper.isin(names), code).otherwise(out)
        return out

    return bind(F.upper(clean_text(c)), of)


def parse_count(c: Column, low: int = 0, high: int | None = None) -> Ruled:
    """PRJ-13: a whole number in range: counts, years, quarters, months."""
    within = lambda n: F.when((n >= low) & (F.lit(True) if high is None else n <= high), n)
    return _ruled(clean_text(c), lambda t: bind(F.when(t.rlike(r"^\d+$"), t.try_cast("bigint")), within), "invalid_number")


def first_path(payload: Column, *paths: str) -> Column:
    """PRJ-14: the first path of a JSON text that holds anything."""
    return F.coalesce(*(F.nullif(F.get_json_object(payload, p), F.lit("")) for p in paths))


def normalised_name(c: Column) -> Column:
    """PRJ-19: upper case, without accents, one blank between words; names compare by it."""
    accented = "ÀÁÂÃÈÉÊÌÍÒÓÔÕÙÚÝĂĐĨŨƠƯẠẢẤẦẨẪẬẮẰẲẴẶẸẺẼẾỀỂỄỆỈỊỌỎỐỒỔỖỘỚỜỞỠỢỤỦỨỪỬỮỰỲỴỶỸ"
    plain = "AAAAEEEIIOOOOUUYADIUOUAAAAAAAAAAAAEEEEEEEEIIOOOOOOOOOOOOUUUUUUUYYYY"
    return F.regexp_replace(F.translate(F.upper(strip(c)), accented, plain), r"\s+", " ")


def digest(*columns: Column) -> Column:
    """PRJ-17, FCT-9: SHA-256 of the JSON list of the columns as text, nulls as null."""
    # Never null, which is said so that joins on it need no filter, for which Spark would compute it twice.
    return F.coalesce(F.sha2(F.to_json(F.array(*(c.cast("string") for c in columns)), {"ignoreNullFields": "false"}), 256), F.lit(""))


def issues(*found: tuple[str | Column, Column, str]) -> Column:
    """Array of (code, path, severity) of the rules that failed; ``found`` has (path, issue, severity)."""
    all_of = F.array(*(F.when(code.isNotNull(), F.struct(code.alias("code"), F.lit(path).alias("path"), F.lit(severity).alias("severity"))) for path, code, severity in found))
    if not found:
        return F.array().cast("array<struct<code:string,path:string,severity:string>>")
    return F.filter(all_of, lambda x: x.isNotNull())
