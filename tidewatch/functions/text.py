"""String expressions: location parts, spelling, labels, number text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from tidewatch import constants as K


WHITE_SPACE = " \t\n\r\f\v"


def location_part(location: Column, n: int, default: str | None = None) -> Column:
    """Part ``n`` (0-based) of a ``/`` separated location, white space trimmed."""
    return trimmed_part(F.split(location, "/"), n, default)


def trimmed_part(parts: Column, n: int, default: str | None = None) -> Column:
    part = F.trim(F.get(parts, F.lit(n)), F.lit(WHITE_SPACE))
    return part if default is None else F.coalesce(part, F.lit(default))


def tight_part(parts: Column, n: int) -> Column:
    """Part ``n`` of a text split on ``/``, less one blank next to each slash."""
    raw = F.get(parts, F.lit(n))
    inner = raw if n == 0 else F.when(
        raw.startswith(" "), F.substr(raw, F.lit(2))).otherwise(raw)
    return F.when(
        (F.size(parts) > n + 1) & inner.endswith(" "),
        F.left(inner, F.length(inner) - 1)).otherwise(inner)


def title_case(name: Column, keep: Sequence[str] = K.LOWERCASE_WORDS) -> Column:
    """Capitalise every blank-separated word unless it is listed in ``keep``."""
    words = F.transform(
        F.split(name, " "),
        lambda w: F.when(w.isin(list(keep)), w).otherwise(
            F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substr(w, F.lit(2))))
        ),
    )
    return F.array_join(words, " ")


def capital_first(s: Column) -> Column:
    return F.concat(F.upper(F.substring(s, 1, 1)), F.substr(s, F.lit(2)))


def lookup(col: Column, mapping: Mapping[str, str]) -> Column:
    """The mapped value, null for values not listed."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), col)


def value_map(col: Column, mapping: Mapping[str, str]) -> Column:
    """Replace listed values, keep all others."""
    return F.coalesce(lookup(col, mapping), col)


def fix_country_titlecased(country: Column) -> Column:
    """Title case, then the preset that aligns names with the case series.

    The USA test ignores case, so it also finds those letters inside other names.
    """
    return F.when(country.ilike(f"%{K.USA_MARK}%"), K.USA_NAME).otherwise(
        value_map(title_case(country), K.COUNTRY_FIXES_TITLECASED))


def fix_country_plain(country: Column) -> Column:
    """The preset of the feed path: a few spellings, first letter capitalised."""
    name = capital_first(country)
    return F.coalesce(
        lookup(country, K.COUNTRY_FIXES_BEFORE_CAPITAL),
        lookup(name, K.COUNTRY_FIXES_AFTER_CAPITAL), name)


def fix_division(division: Column) -> Column:
    return value_map(division, K.DIVISION_FIXES)


def name_key(name: Column) -> Column:
    """Normalised form of a country name, for exact crosswalk joins.

    Lower case without blanks and punctuation; no regular expression, because it
    runs on every record that is joined.  Never null: a nullable join key would
    make Spark repeat the whole expression in a not-null filter.
    """
    return F.coalesce(F.translate(F.lower(name), " .,'’`-()&/*", ""), F.lit(""))


def contains_any(col: Column, marks: Sequence[str]) -> Column:
    """Literal substring test; null when the text is null."""
    hit = col.contains(marks[0])
    for mark in marks[1:]:
        hit = hit | col.contains(mark)
    return hit


def parse_grouped_int(text: Column) -> Column:
    """``'1,234'`` to 1234; text that is no number becomes null."""
    return F.regexp_replace(text, ",", "").try_cast("bigint")


def grouped_int(x: Column) -> Column:
    return F.format_number(x, 0)


def number_text(x: Column) -> Column:
    """A number as text, without a trailing ``.0``."""
    return F.regexp_replace(x.cast("string"), "\\.0$", "")


def with_percent(text: Column, suffix: str = " %") -> Column:
    return F.concat(text, F.lit(suffix))


def with_plus(text: Column, number: Column) -> Column:
    """Put ``+ `` in front when the underlying number is positive."""
    return F.when(number > 0, F.concat(F.lit("+ "), text)).otherwise(text)


def who_region_label(region: Column) -> Column:
    return F.concat(F.lit(K.WHO_REGION_PREFIX), region)


def hour_stamp(ts: Column, sep: str = "-") -> Column:
    """``2021-12-22-13`` style stamp of a run."""
    return F.date_format(ts, f"yyyy{sep}MM{sep}dd{sep}HH")
