"""Resource and page addresses of an encyclopedia."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Output formats and the characters escaped in them.
RESOURCE = "http://%s.dbpedia.org/resource/%s"
PAGE = "http://%s.wikipedia.org/wiki/%s"
SUBJECT_PREDICATE = "http://purl.org/dc/terms/subject"
ESCAPED = "%\"#<>?[\\]^`{|}"


def underscored(text: Column | str) -> Column:
    """Text in address form: single underscores for spaces, reserved characters escaped."""
    return escape(F.replace(_spaced(text), F.lit(" "), F.lit("_")))


def page_name(title: Column | str) -> Column:
    """A title in address form, with a capital first letter."""
    spaced = _spaced(title)
    return underscored(F.concat(F.upper(F.substring(spaced, 1, 1)), F.substr(spaced, F.lit(2))))


def _spaced(text: Column | str) -> Column:
    return F.trim(F.regexp_replace(text, r"[\s_]+", " "))


def escape(name: Column) -> Column:
    return reduce(lambda s, c: F.replace(s, F.lit(c), F.lit(f"%{ord(c):02X}")), ESCAPED, name)


def resource_iri(lang: Column, name: Column) -> Column:
    return F.format_string(RESOURCE, lang, name)


def page_iri(lang: Column, name: Column) -> Column:
    return F.format_string(PAGE, lang, name)
