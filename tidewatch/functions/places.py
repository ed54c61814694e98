"""Country names as people write them: recognised by their words, and named by code.

The regular part comes from the JVM's own list of countries: every ISO code with its English
name, whose words a name has to hold.  ``constants.COUNTRY_NAME_RULES`` replaces the words of
countries that go by other names too.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch import constants as K

#: By first letter and word: a look-up in a map passes its keys one by one.
RULES = "map<string, map<string, array<struct<code string, needs array<string>, bars array<string>>>>>"

#: Latin letters with marks, by the rule that their first decomposed character is the plain one.
_MARKED = [chr(c) for c in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)) if unicodedata.decomposition(chr(c))]
_MARKED = [c for c in _MARKED if unicodedata.normalize("NFD", c)[0].isascii()]
_PLAIN = "".join(unicodedata.normalize("NFD", c)[0] for c in _MARKED)


@functools.cache
def iso_countries() -> tuple[tuple[str, str], ...]:
    """(three-letter code, English name) of every country the JVM lists; needs a session."""
    locale = SparkSession.getActiveSession()._jvm.java.util.Locale
    found = []
    for region in locale.getISOCountries():
        country = locale("", region)
        found.append((country.getISO3Country(), country.getDisplayCountry(locale.ENGLISH)))
    return tuple(sorted(found))


def name_words(name: Column) -> Column:
    """The distinct words of a name: plain small letters, abbreviations spelled out.

    Initials with stops are one word, apostrophes go, words that only connect are left out.
    """
    plain = F.translate(F.lower(F.translate(name, "".join(_MARKED), _PLAIN)), "'’`´", "")
    joined = F.regexp_replace(plain, r"\b([a-z])\.", "$1")
    words = F.split(F.regexp_replace(joined, "[^a-z0-9]+", " "), " ")
    full = F.from_json(F.lit(json.dumps(K.NAME_ABBREVIATIONS)), "map<string, string>")
    spelled = F.transform(words, lambda w: F.coalesce(F.try_element_at(full, w), w))
    return F.array_distinct(F.filter(spelled, lambda w: ~w.isin("", *K.NAME_CONNECTORS)))


def _words_of(name: str) -> list[str]:
    """:func:`name_words` of a constant, less what stands in parentheses."""
    plain = unicodedata.normalize("NFD", re.sub(r"\(.*?\)", " ", name)).encode("ascii", "ignore").decode()
    joined = re.sub(r"\b([a-z])\.", r"\1", re.sub("['’`´]", "", plain.lower().replace("’", "")))
    words = (K.NAME_ABBREVIATIONS.get(w, w) for w in re.split("[^a-z0-9]+", joined))
    return [w for w in dict.fromkeys(words) if w and w not in K.NAME_CONNECTORS]


@functools.cache
def name_rules() -> tuple[tuple[str, tuple[str, ...], tuple[str, ...]], ...]:
    """(code, words needed, words barred), one rule for each way to name a country."""
    rules = []
    for code, name in iso_countries():
        if code not in K.COUNTRY_NAME_RULES:
            rules.append((code, tuple(_words_of(name)), ()))
    for code, ways in K.COUNTRY_NAME_RULES.items():
        for way in ways:
            parts = way.split()
            rules.append((code, tuple(w for w in parts if w[0] != "-"),
                          tuple(w[1:] for w in parts if w[0] == "-")))
    return tuple(rules)


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it.

    A lambda computes what it captures for each element anew, unless it is itself the variable
    of a lambda.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _best(words: Column, rules: Column) -> Column:
    """The code of the rule with most words among those that hold; null if two codes tie."""
    listed = F.filter(
        F.transform(words, lambda w: F.try_element_at(F.try_element_at(rules, F.left(w, F.lit(1))), w)),
        lambda r: r.isNotNull())
    held = F.filter(
        F.flatten(listed),
        lambda r: (F.size(F.array_except(r["needs"], words)) == 0) & ~F.arrays_overlap(r["bars"], words))

    def longest(held: Column) -> Column:
        most = F.array_max(F.transform(held, lambda r: F.size(r["needs"])))
        return _bound(most, lambda most: F.array_distinct(F.transform(
            F.filter(held, lambda r: F.size(r["needs"]) == most), lambda r: r["code"])))

    return _bound(_bound(held, longest), lambda codes: F.when(F.size(codes) == 1, F.get(codes, F.lit(0))))


def country_by_words(name: Column) -> Column:
    """The code of the country a text names, null where it names none or several.

    Of rules that hold, the one with most words decides, so Papua New Guinea is not Guinea.
    Where the whole text decides nothing, the part before a parenthesis may.  One expression
    over constants: no join and no second read; ``coalesce`` with an exact match runs it for
    the rest only.  The words of a text are taken once.
    """
    by_word: dict[str, dict[str, list[dict]]] = {}
    for code, needs, bars in name_rules():
        word = max(needs, key=len)
        by_word.setdefault(word[0], {}).setdefault(word, []).append({"code": code, "needs": needs, "bars": bars})
    rules = F.from_json(F.lit(json.dumps({"x": by_word})), f"x {RULES}")["x"]
    best = lambda text: _bound(name_words(text), lambda words: _best(words, rules))
    return F.coalesce(best(name), F.when(name.contains("("), best(F.substring_index(name, "(", 1))))


def country_names(spark: SparkSession) -> DataFrame:
    """(code, name) of every country, as constants of the plan."""
    rows = json.dumps([{"code": c, "name": n} for c, n in iso_countries()])
    return spark.range(1).select(F.inline(F.from_json(F.lit(rows), "array<struct<code string, name string>>")))
