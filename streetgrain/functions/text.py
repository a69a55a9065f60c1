"""Text and number expressions shared by the other modules.

Everything here is a ``Column`` built from JVM-side functions, so whole-stage
code generation stays intact.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as blank at either end of a text.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

NUMBER_TEXT = r"^\s*[+-]?((\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?|(?i:nan|inf|infinity))\s*$"

# Text that a JSON string holds without any escape.
PLAIN_JSON = r"^[ !#-\[\]-~]*$"


def strip(column: Column) -> Column:
    """Remove blanks of every kind from both ends."""
    return F.btrim(column, F.lit(BLANKS))


def is_blank(column: Column) -> Column:
    return F.coalesce(strip(column) == "", F.lit(True))


def parse_number(column: Column) -> Column:
    """Text to double; null where the text is not a number.

    A plain cast would also take Java literals such as ``1d`` or ``0x1p3``. The
    cast itself skips blanks around the number.
    """
    return F.when(column.rlike(NUMBER_TEXT), column.try_cast("double"))


def json_string(column: Column) -> Column:
    """A JSON string literal in pure ASCII; the JSON word null for a null."""
    char_text = lambda c: (
        F.when(c == '"', F.lit('\\"'))
        .when(c == "\\", F.lit("\\\\"))
        .when(c == "\n", F.lit("\\n"))
        .when(c == "\r", F.lit("\\r"))
        .when(c == "\t", F.lit("\\t"))
        .when(c == "\b", F.lit("\\b"))
        .when(c == "\f", F.lit("\\f"))
        .when(c.rlike("^[ -~]$"), c)
        .otherwise(
            F.regexp_replace(F.lower(F.hex(F.encode(c, "UTF-16BE"))), "(....)", r"\\u$1")
        )
    )
    characters = F.regexp_extract_all(column, F.lit("(?s)."), F.lit(0))
    plain = column.rlike(PLAIN_JSON)
    body = F.when(plain, column).otherwise(F.array_join(F.transform(characters, char_text), ""))
    return F.when(column.isNull(), F.lit("null")).otherwise(F.concat(F.lit('"'), body, F.lit('"')))


def strip_zeros(column: Column) -> Column:
    """Drop a useless fraction from plain decimal text: ``1.50`` -> ``1.5``."""
    return F.regexp_replace(F.regexp_replace(column, r"(\.\d*?)0+$", "$1"), r"\.$", "")


def nice_integer(column: Column) -> Column:
    """Whole number with comma-separated thousands."""
    return F.format_number(column, 0)


_SIZES = ("B", "KB", "MB", "GB", "TB")  # each 1024 of the one before
# A unit, its seconds, and the age beyond which it is used.
_AGES = (("minutes", 60, 90), ("hours", 3600, 5400), ("days", 86400, 129600))
_WEEKS_FROM, _DATES_FROM = 13, 91  # whole days


def nice_size(column: Column) -> Column:
    """Byte count with a unit; one decimal below ten."""
    step = F.lit(0)
    for power in range(1, len(_SIZES)):
        step = F.when(column >= 1024.0**power, power).otherwise(step)
    number = column / F.pow(F.lit(1024.0), step)
    places = lambda n: F.format_string(f"%.{n}f", F.bround(number, n))
    unit = F.element_at(F.array(*[F.lit(u) for u in _SIZES]), step + 1)
    return F.concat(F.when(number < 10, places(1)).otherwise(places(0)), unit)


def nice_age(seconds: Column, now: Column) -> Column:
    """Age in words; a calendar date once it is more than ninety days."""
    words = lambda length, unit: F.concat(F.format_string("%.0f", F.bround(seconds / float(length), 0)), F.lit(f" {unit} ago"))
    age = words(1, "seconds")
    for unit, length, beyond in _AGES:
        age = F.when(seconds > beyond, words(length, unit)).otherwise(age)
    days = F.floor(seconds / 86400)
    moment = F.timestamp_micros(F.unix_micros(now) - seconds.cast("bigint") * 1000000)
    age = F.when(days >= _WEEKS_FROM, words(7 * 86400, "weeks")).otherwise(age)
    return F.when(days >= _DATES_FROM, F.date_format(moment, "MMM dd, yyyy")).otherwise(age)


def boolean_text(column: Column) -> Column:
    """true / false, and the empty text for a null."""
    return F.coalesce(column.cast("string"), F.lit(""))


def duration_seconds(column: Column) -> Column:
    """Seconds of an ``H:MM:SS.f`` text; null where it is not one."""
    part = lambda i: F.try_element_at(F.split(column, ":"), F.lit(i)).try_cast("double")
    return part(1) * 3600 + part(2) * 60 + part(3)


def epoch_text(column: Column) -> Column:
    """Seconds since 1970 with exactly three decimals, as text."""
    micros = F.unix_micros(column).cast("decimal(20,0)")
    return F.round((micros / F.lit(1000000).cast("decimal(7,0)")).cast("decimal(20,6)"), 3).cast("string")


def short_name(path: Column, root: str = "sources") -> Column:
    """Source path without the leading folder and the extension."""
    relative = F.regexp_replace(path, f"^{root}/", "")
    return F.regexp_replace(relative, r"(?<=[^/])\.[^./]*$", "")


def relative_path(path: Column, root: str = "sources") -> Column:
    return F.regexp_replace(path, f"^{root}/", "")


def url_parts(url: Column) -> dict[str, Column]:
    """Scheme, host, path and query of a URL by pattern; empty where absent."""
    pattern = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"
    names = {"scheme": 1, "host": 2, "path": 3, "query": 4}
    return {name: F.regexp_extract(url, pattern, i) for name, i in names.items()}


def file_extension(path: Column) -> Column:
    """Extension of a path with its dot; a leading dot of a name is not one."""
    return F.regexp_extract(path, r"[^/.][^/]*?(\.[^./]*)$", 1)


# URL extensions that say nothing about the content.
WEAK_EXTENSIONS = ["", ".cgi", ".php", ".aspx", ".asp", ".do"]

# Content types of address data files.
CONTENT_TYPE_EXTENSIONS = {
    "application/zip": ".zip",
    "application/x-zip-compressed": ".zip",
    "application/json": ".json",
    "application/vnd.geo+json": ".json",
    "application/gml+xml": ".gml",
    "application/vnd.google-earth.kml+xml": ".kml",
    "application/xml": ".xml",
    "text/xml": ".xml",
    "text/csv": ".csv",
    "text/plain": ".txt",
    "text/html": ".html",
}


def guess_extension(
    url: Column,
    content_type: Column | None = None,
    disposition: Column | None = None,
    sniffed_type: Column | None = None,
) -> Column:
    """Extension for a download.

    A URL without a query and with a telling extension decides. Otherwise the
    content type decides unless the content disposition contradicts it; last
    comes the type found by looking at the content.
    """
    parts = url_parts(url)
    from_url = file_extension(parts["path"])
    none = F.lit(None).cast("string")
    pairs = [F.lit(x) for item in CONTENT_TYPE_EXTENSIONS.items() for x in item]
    known = F.create_map(*pairs)
    by_type = lambda c: none if c is None else F.try_element_at(
        known, F.lower(strip(F.split(c, ";")[0]))
    )
    declared = by_type(content_type)
    if disposition is not None:
        name = F.regexp_replace(
            F.regexp_extract(disposition, r'(?i)^attachment; filename=("?)([^;]+)\1', 2), '"$', ""
        )
        contradicts = (name != "") & ~file_extension(name).eqNullSafe(declared)
        declared = F.when(F.coalesce(contradicts, F.lit(False)), none).otherwise(declared)
    trusted = (parts["query"] == "") & ~from_url.isin(WEAK_EXTENSIONS)
    return F.when(trusted, from_url).otherwise(F.coalesce(declared, by_type(sniffed_type)))


def stable_name(prefix: str | None, url: Column) -> Column:
    """File name base for a URL: the prefix and eight hex digits of a hash.

    The hash covers host and path without extension, so that it survives a
    change of the query. Without a prefix the name in the URL is used.
    """
    parts = url_parts(url)
    extension = file_extension(parts["path"])
    base = parts["path"].substr(F.lit(1), F.length(parts["path"]) - F.length(extension))
    if prefix is None:
        return F.regexp_extract(base, r"([^/]*)$", 1)
    return F.concat(F.lit(f"{prefix}-"), F.substring(F.sha1(F.concat(parts["host"], base)), 1, 8))


def canonical_url(url: Column, host: str) -> Column:
    """One https form for the storage URLs of a data host.

    The host itself, the path-style and the host-style storage address all
    become ``https://host/path``; any other URL stays as it is.
    """
    parts = url_parts(url)
    name = F.lower(F.regexp_replace(F.regexp_replace(parts["host"], "^[^@]*@", ""), r":\d*$", ""))
    storage = "s3.amazonaws.com"
    prefix = f"/{host}/"
    direct = (name == host) | (name == f"{host}.{storage}")
    folder = (name == storage) & parts["path"].startswith(prefix)
    return (
        F.when(direct, F.concat(F.lit(f"https://{host}"), parts["path"]))
        .when(
            folder,
            F.concat(F.lit(f"https://{host}"), parts["path"].substr(F.lit(len(prefix)), F.length(parts["path"]))),
        )
        .otherwise(url)
    )
