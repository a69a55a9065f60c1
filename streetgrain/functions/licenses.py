"""Licence tags of a source definition, as expressions over its JSON text.

``license`` and ``attribution`` are the JSON texts of the two tags; null where
the tag is absent.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that stand for yes and no.
NO_WORDS = ["n", "no", "f", "false", ""]
YES_WORDS = ["y", "yes", "t", "true"]


def _is_object(json: Column) -> Column:
    return F.coalesce(F.ltrim(json).startswith("{"), F.lit(False))


def _has(json: Column, key: str) -> Column:
    return F.coalesce(F.array_contains(F.json_object_keys(json), key), F.lit(False))


def _text(json: Column, key: str) -> Column:
    return F.get_json_object(json, f"$['{key}']")


def _scalar(json: Column) -> Column:
    """Text of a JSON scalar: the content of a string, else its literal."""
    return F.get_json_object(F.concat(F.lit('{"v":'), json, F.lit("}")), "$.v")


def _is_string(json: Column) -> Column:
    return F.coalesce(F.ltrim(json).startswith('"'), F.lit(False))


def _member(json: Column, key: str) -> Column:
    """Raw JSON text of one member."""
    return F.try_element_at(F.from_json(json, "map<string,string>"), F.lit(key))


def license_text(license: Column) -> Column:
    """Plain text of a licence given as a string or as an object."""
    text, url = _text(license, "text"), _text(license, "url")
    from_object = (
        F.when(_has(license, "url") & _has(license, "text"), F.concat(text, F.lit(" ("), url, F.lit(")")))
        .when(_has(license, "url"), url)
        .when(_has(license, "text"), text)
    )
    return F.when(_is_object(license), from_object).when(F.trim(license) != "null", _scalar(license))


def attribution(license: Column, attribution: Column) -> Column:
    """struct(flag, name): whether attribution is required, and to whom.

    An old-style attribution tag gives a first guess, the licence object may
    name somebody, and its explicit flag has the last word.
    """
    plain = F.trim(attribution)
    old = F.coalesce(~plain.isin("null", "false", '""'), F.lit(False))
    old_name = F.when(old, _scalar(attribution))

    new_name = _text(license, "attribution name")
    named = _is_object(license) & _has(license, "attribution name") & (F.coalesce(new_name, F.lit("x")) != "")
    flag = F.when(named | old, F.lit(True)).otherwise(F.lit(False))
    name = F.when(named, F.coalesce(new_name, F.lit("None"))).otherwise(old_name)

    explicit = _is_object(license) & _has(license, "attribution")
    raw = F.lower(F.coalesce(_text(license, "attribution"), F.lit("null")))
    given = F.when(raw == "null", F.lit(None).cast("boolean")).otherwise(~raw.isin("false", "0", ""))
    flag = F.when(explicit, given).otherwise(flag)
    flag = F.when(flag.isNull() & F.coalesce(name != "", F.lit(False)), F.lit(True)).otherwise(flag)
    name = F.when(F.coalesce(flag, F.lit(False)), name)
    return F.struct(flag.alias("flag"), name.alias("name"))


def share_alike(license: Column) -> Column:
    """True or false from the share-alike tag; null when it says neither."""
    word = F.lower(_text(license, "share-alike"))
    value = (
        F.when(word.isNull() | word.isin(NO_WORDS), F.lit(False))
        .when(word.isin(YES_WORDS), F.lit(True))
    )
    return F.when(_is_object(license) & _has(license, "share-alike"), value)


def license_class(share_alike_text: Column) -> Column:
    """``sa`` for share-alike sources, else the empty text."""
    return F.when(share_alike_text == "true", F.lit("sa")).otherwise(F.lit(""))
