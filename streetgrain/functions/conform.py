"""Compiler from a conform specification to address columns.

A specification maps address attributes to a column name (copy), a list of
names (joined by blanks) or a function object. Every attribute compiles to one
``Column``; the whole specification becomes a single projection that fuses with
the scan, so a conform run never shuffles and never leaves the JVM.

Rows that the specification cannot handle (a null or a missing array element
where text is needed) carry a message in ``_error``; see :func:`conform`.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streetgrain.functions.numbers import round_coordinates
from streetgrain.functions.text import PLAIN_JSON, is_blank, json_string, strip
from streetgrain.schema import ADDRESS_COLUMNS, ATTRIBUTES, X_COLUMN, Y_COLUMN


class ConformError(ValueError):
    """The specification itself is wrong; found before any data is read."""


@dataclass
class Compiled:
    """A value and the row conditions under which it cannot be computed."""

    value: Column
    problems: list[tuple[Column, str]] = field(default_factory=list)


class Scope:
    """Columns by lower-case name, plus values made so far by the spec."""

    def __init__(self, names: Iterable[str]):
        self._columns = {n.lower(): F.col(f"`{n}`") for n in names}
        self._made: dict[str, Column] = {}

    def __contains__(self, name: str) -> bool:
        return name.lower() in self._made or name.lower() in self._columns

    def get(self, name: str) -> Column:
        key = name.lower()
        if key in self._made:
            return self._made[key]
        if key in self._columns:
            return self._columns[key]
        raise ConformError(f"unknown field {name!r}")

    def put(self, name: str, value: Column) -> None:
        self._made[name.lower()] = value


Function = Callable[[dict, Scope, str], Compiled]
_FUNCTIONS: dict[str, Function] = {}


def register_conform_function(name: str, compiler: Function) -> None:
    """Add a function that specifications may name.

    ``compiler(spec, scope, target)`` returns a :class:`Compiled`; it builds
    columns and never sees rows.
    """
    _FUNCTIONS[name] = compiler


def _function(name: str):
    def wrap(compiler: Function) -> Function:
        register_conform_function(name, compiler)
        return compiler

    return wrap


def _needs(columns: dict[str, Column]) -> list[tuple[Column, str]]:
    return [(c.isNull(), f"no value in field {name}") for name, c in columns.items()]


def merge(spec: list[str], scope: Scope) -> Compiled:
    """Join fields with single blanks, untrimmed."""
    columns = {name: scope.get(name) for name in spec}
    return Compiled(F.concat_ws(" ", *columns.values()), _needs(columns))


@_function("join")
def _join(spec: dict, scope: Scope, target: str) -> Compiled:
    parts = [strip(F.coalesce(scope.get(n), F.lit(""))) for n in spec["fields"]]
    filled = F.filter(F.array(*parts), lambda p: p != "")
    return Compiled(F.array_join(filled, spec.get("separator", " ")))


# --- regular expressions -------------------------------------------------

_REFERENCE = re.compile(r"\$(?:(\d+)|\{(\d+)\})")
_TEMPLATE_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "f": "\f", "v": "\x0b", "a": "\a", "b": "\b", "\\": "\\"}


_PIECE = re.compile(
    r"\\(?P<escape>.)|\(\?P<(?P<name>\w+)>|\(\?P=(?P<back>\w+)\)|(?P<condition>\(\?\()|(?P<open>\[\^?\]?)|(?P<other>.)", re.S
)


def java_pattern(pattern: str) -> str:
    """The same pattern in the regex dialect of the JVM.

    Unicode classes, and only a line feed ends a line. Named groups go by
    number, as JVM names have no underscore; inside a class an opening bracket
    and ``&&`` are plain. A conditional group has no counterpart and is an error.
    """
    numbers = re.compile(pattern).groupindex
    out, inside = ["(?dU)"], False
    for m in _PIECE.finditer(pattern):
        if m["escape"]:
            out.append(r"\z" if m["escape"] == "Z" and not inside else m[0])
        elif inside:
            # In a class brackets and && are plain, and other pieces are only characters.
            for c in m[0]:
                out.append("\\" + c if inside and c in "[&" else c)
                inside = inside and c != "]"
        elif m["name"]:
            out.append(f"(?<g{numbers[m['name']]}>")
        elif m["back"]:
            out.append(rf"\k<g{numbers[m['back']]}>")
        elif m["condition"]:
            raise ConformError(f"conditional group in pattern {pattern!r}")
        elif m["open"]:
            inside = True
            # A bracket that closes at once is a member of the class.
            out.append(m[0].replace("]", r"\]"))
        else:
            out.append(m[0])
    return "".join(out)


def _check_pattern(pattern: str, translated: str) -> None:
    """An error now, not in a task, if the JVM can't read a pattern."""
    session = SparkSession.getActiveSession()
    if session is not None:
        try:
            session._jvm.java.util.regex.Pattern.compile(translated)
        except Py4JJavaError as error:
            raise ConformError(f"bad pattern {pattern!r}: {error.java_exception.getMessage()}") from error


def _literal(text: str) -> str:
    return re.sub(r"([\\$])", r"\\\1", text)


def java_replacement(template: str, groups: int) -> str:
    """Replacement text for the JVM from ``$n`` / ``${n}`` syntax."""

    def group(number: str, following: str) -> str:
        if int(number) > groups:
            raise ConformError(f"replacement refers to group {number} of {groups}")
        # A digit right behind the reference would be read as part of it.
        return f"${int(number)}" + ("\\" if following[:1].isdigit() else "")

    out, position = [], 0
    while position < len(template):
        reference = _REFERENCE.match(template, position)
        slash = re.compile(r"\\(?:g<(\d+)>|(\d{1,2})|(.))", re.S).match(template, position)
        if reference:
            position = reference.end()
            out.append(group(reference.group(1) or reference.group(2), template[position:]))
        elif slash:
            position = slash.end()
            if slash.group(3) is None:
                out.append(group(slash.group(1) or slash.group(2), template[position:]))
            else:
                out.append(_literal(_TEMPLATE_ESCAPES.get(slash.group(3), slash.group(0))))
        else:
            out.append(_literal(template[position]))
            position += 1
    return "".join(out)


@_function("regexp")
def _regexp(spec: dict, scope: Scope, target: str) -> Compiled:
    source = scope.get(spec["field"])
    problems = _needs({spec["field"]: source})
    try:
        groups = re.compile(spec["pattern"]).groups
    except re.error as error:
        raise ConformError(f"bad pattern {spec['pattern']!r}: {error}") from error
    pattern = java_pattern(spec["pattern"])
    _check_pattern(spec["pattern"], pattern)
    if spec.get("replace"):
        replacement = java_replacement(spec["replace"], groups)
        return Compiled(F.regexp_replace(source, F.lit(pattern), F.lit(replacement)), problems)
    if groups == 0:
        return Compiled(F.when(source.isNotNull(), F.lit("")), problems)
    found = [F.regexp_extract(source, pattern, i + 1) for i in range(groups)]
    return Compiled(F.concat(*found), problems)


# --- house numbers, streets and units ------------------------------------

# Shapes of a leading house number and of a trailing unit.
HOUSE_NUMBER = r"\d+(?:[ -]\d/\d)?|\d+-\d+|\d+-?[A-Z]"
UNIT = r"(?:(?:UNIT|APARTMENT|APT\.?|SUITE|STE\.?|BUILDING|BLDG\.?|LOT)\s+|#).+"
PREFIXED_NUMBER = rf"(?idU)^\s*({HOUSE_NUMBER})\s+"
POSTFIXED_STREET = rf"(?idU)^(?:\s*(?:{HOUSE_NUMBER})\s+)?(.*)"
POSTFIXED_STREET_WITH_UNITS = rf"(?idU)^(?:\s*(?:{HOUSE_NUMBER})\s+)?(.+?)(?:\s+{UNIT})?$"
POSTFIXED_UNIT = rf"(?idU)\s({UNIT})$"


def _extract(pattern: str, spec: dict, scope: Scope) -> Compiled:
    source = scope.get(spec["field"])
    return Compiled(F.regexp_extract(source, pattern, 1), _needs({spec["field"]: source}))


@_function("prefixed_number")
def _prefixed_number(spec: dict, scope: Scope, target: str) -> Compiled:
    return _extract(PREFIXED_NUMBER, spec, scope)


@_function("postfixed_street")
def _postfixed_street(spec: dict, scope: Scope, target: str) -> Compiled:
    units = spec.get("may_contain_units", False)
    return _extract(POSTFIXED_STREET_WITH_UNITS if units else POSTFIXED_STREET, spec, scope)


@_function("postfixed_unit")
def _postfixed_unit(spec: dict, scope: Scope, target: str) -> Compiled:
    return _extract(POSTFIXED_UNIT, spec, scope)


# --- removing, formatting, chaining, picking ------------------------------


def _pair(spec: dict, scope: Scope) -> dict[str, Column]:
    return {n: scope.get(n) for n in (spec["field"], spec["field_to_remove"])}


@_function("remove_prefix")
def _remove_prefix(spec: dict, scope: Scope, target: str) -> Compiled:
    text, unwanted = scope.get(spec["field"]), scope.get(spec["field_to_remove"])
    rest = F.ltrim(text.substr(F.length(unwanted) + 1, F.length(text)))
    value = F.when(text.startswith(unwanted), rest).otherwise(text)
    return Compiled(value, _needs(_pair(spec, scope)))


@_function("remove_postfix")
def _remove_postfix(spec: dict, scope: Scope, target: str) -> Compiled:
    text, unwanted = scope.get(spec["field"]), scope.get(spec["field_to_remove"])
    rest = F.rtrim(text.substr(F.lit(1), F.length(text) - F.length(unwanted)))
    value = F.when((unwanted != "") & text.endswith(unwanted), rest).otherwise(text)
    return Compiled(value, _needs(_pair(spec, scope)))


@_function("format")
def _format(spec: dict, scope: Scope, target: str) -> Compiled:
    fields = [strip(F.coalesce(scope.get(n), F.lit(""))) for n in spec["fields"]]
    template = spec["format"]
    pieces: list[Column] = []
    placed = F.lit(False)
    end = 0
    for match in re.finditer(r"\$([0-9]+)", template):
        index = int(match.group(1)) - 1
        literal, first = template[end : match.start()], end == 0
        end = match.end()
        if not 0 <= index < len(fields):
            continue
        value = fields[index]
        filled = value != ""
        if literal:
            # The opening literal always stays; a later one only joins two values.
            pieces.append(F.lit(literal) if first else F.when(placed & filled, F.lit(literal)))
        pieces.append(without_point_zero(value))
        placed = placed | filled
    pieces.append(F.lit(template[end:]))
    return Compiled(F.when(placed, F.concat_ws("", *pieces)).otherwise(F.lit("")))


@_function("chain")
def _chain(spec: dict, scope: Scope, target: str) -> Compiled:
    # Steps hand their value on under the attribute's own name, or under a name that
    # the specification gives and that nothing else has; that one begins as empty text.
    name = spec.get("variable") or target
    fresh = name != target and name.removeprefix("OA:") not in ATTRIBUTES and name not in scope
    inner = name if fresh else target
    if fresh:
        scope.put(inner, F.lit(""))
    value = scope.get(inner) if inner in scope else None
    problems: list[tuple[Column, str]] = []
    for step in spec["functions"]:
        done = compile_function(step, scope, inner)
        value = done.value
        problems += done.problems
        scope.put(inner, value)
    if value is None:
        raise ConformError("a chain needs at least one function")
    return Compiled(value, problems)


@_function("first_non_empty")
def _first_non_empty(spec: dict, scope: Scope, target: str) -> Compiled:
    choices = [scope.get(n) for n in spec.get("fields", [])]
    kept = scope.get(target) if target in scope else F.lit(None).cast("string")
    return Compiled(F.coalesce(*[F.when(~is_blank(c), c) for c in choices], kept))


@_function("get")
def _get(spec: dict, scope: Scope, target: str) -> Compiled:
    source, index = scope.get(spec["field"]), spec["index"]
    bare = F.replace(F.translate(source, "[]'", ""), F.lit(", "), F.lit(","))
    value = F.try_element_at(F.split(bare, ","), F.lit(index + 1 if index >= 0 else index))
    missing = source.isNotNull() & value.isNull()
    return Compiled(value, _needs({spec["field"]: source}) + [(missing, f"no element {index}")])


def compile_function(spec: dict, scope: Scope, target: str) -> Compiled:
    name = spec.get("function")
    if name not in _FUNCTIONS:
        raise ConformError(f"unknown conform function {name!r}")
    return _FUNCTIONS[name](spec, scope, target)


# --- the whole specification ----------------------------------------------


def work_column(attribute: str) -> str:
    return f"OA:{attribute}"


def compile_attributes(spec: dict, names: Iterable[str]) -> tuple[dict[str, Column], list]:
    """Columns of all address attributes before canonical clean-up."""
    for unsupported in ("advanced_merge", "split"):
        if unsupported in spec:
            raise ConformError(f"unsupported option {unsupported!r}")
    scope = Scope(names)
    problems: list[tuple[Column, str]] = []
    for attribute, rule in spec.items():
        if attribute not in ATTRIBUTES or not isinstance(rule, (list, dict)):
            continue
        target = work_column(attribute)
        done = merge(rule, scope) if isinstance(rule, list) else compile_function(rule, scope, target)
        scope.put(target, done.value)
        problems += [(c, f"{attribute}: {m}") for c, m in done.problems]
    none = F.lit(None).cast("string")
    values = {}
    for attribute in ATTRIBUTES:
        rule = spec.get(attribute)
        if work_column(attribute) in scope:
            values[attribute] = scope.get(work_column(attribute))
        elif isinstance(rule, str) and rule and rule in scope:
            values[attribute] = scope.get(rule)
        else:
            values[attribute] = none
    for key, name in (("lon", X_COLUMN), ("lat", Y_COLUMN)):
        values[key] = scope.get(name) if name in scope else none
    return values, problems


def without_point_zero(text: Column) -> Column:
    return F.when(text.endswith(".0"), text.substr(F.lit(1), F.length(text) - 2)).otherwise(text)


def canonical_number(column: Column) -> Column:
    """Trimmed house number without a ``.0`` that a float column left behind."""
    return without_point_zero(canonical_text(column))


def canonical_text(column: Column) -> Column:
    return strip(F.coalesce(column, F.lit("")))


def row_hash(fingerprint: str | Column, columns: dict[str, Column]) -> Column:
    """Sixteen hex digits over the fingerprint and the name-sorted values."""
    if isinstance(fingerprint, str):
        fingerprint = F.lit(fingerprint)

    def document(quoted) -> Column:
        pairs: list[Column] = [fingerprint]
        for position, name in enumerate(sorted(columns)):
            lead = ("[" if position == 0 else ",") + f'["{name}",'
            pairs += [F.lit(lead), quoted(columns[name]), F.lit("]")]
        return F.concat(*pairs, F.lit("]"))

    # Most rows need no escape anywhere; one test tells for all values.
    plain = F.concat_ws("", *columns.values()).rlike(PLAIN_JSON)
    bare = lambda c: F.coalesce(F.concat(F.lit('"'), c, F.lit('"')), F.lit("null"))
    text = F.when(plain, document(bare)).otherwise(document(json_string))
    return F.substring(F.sha1(text), 1, 16)


def address_columns(spec: dict, names: Iterable[str]) -> tuple[dict[str, Column], Column]:
    """Cleaned attributes with the coordinates still as read, and the message."""
    values, problems = compile_attributes(spec, names)
    out = {
        "LON": values["lon"],
        "LAT": values["lat"],
        "NUMBER": canonical_number(values["number"]),
        "STREET": canonical_text(values["street"]),
        "UNIT": canonical_text(values["unit"]),
        "CITY": values["city"],
        "DISTRICT": values["district"],
        "REGION": values["region"],
        "POSTCODE": values["postcode"],
        "ID": values["id"],
    }
    out = {name: column.cast("string") for name, column in out.items()}
    error = F.coalesce(*[F.when(c, F.lit(m)) for c, m in problems], F.lit(None).cast("string"))
    return out, error


def conform(
    df: DataFrame,
    spec: dict,
    fingerprint: str | Column,
    keep: Iterable[str] = (),
    fail_on_error: bool = False,
) -> DataFrame:
    """Turn an extracted source table into the address table.

    ``fingerprint`` seeds the row hash: a text per source, or a column where
    the rows of many sources are conformed by one job. Columns named in
    ``keep`` are passed through behind the address columns. A row the spec
    cannot handle has a message in ``_error``, or stops the job when
    ``fail_on_error`` is set.
    """
    columns, error = address_columns(spec, df.columns)
    if fail_on_error:
        first = F.when(error.isNotNull(), F.raise_error(error).cast("string"))
        columns["LON"] = F.coalesce(first, columns["LON"])
    seed = F.lit(fingerprint) if isinstance(fingerprint, str) else fingerprint
    # A chain of projections: each reads finished values of the one before
    # instead of repeating their expressions. Nothing here shuffles.
    rows = df.select(
        *[c.alias(n) for n, c in columns.items()],
        error.alias("_error"),
        seed.alias("_seed"),
        *[F.col(f"`{k}`").alias(f"_keep_{k}") for k in keep],
    )
    rows = round_coordinates(rows, ["LON", "LAT"])
    digest = row_hash(F.col("_seed"), {n: F.col(n) for n in columns})
    return rows.select(
        *[F.col(n) for n in ADDRESS_COLUMNS if n != "HASH"],
        digest.alias("HASH"),
        "_error",
        *[F.col(f"`_keep_{k}`").alias(k) for k in keep],
    )


# --- column pruning ---------------------------------------------------------


def _function_fields(rule: dict) -> set[str]:
    name = rule.get("function")
    if name == "chain":
        inner = set().union(*[_function_fields(f) for f in rule["functions"] if isinstance(f, dict)], set())
        return inner - {rule.get("variable")}
    if "fields" in rule:
        return set(rule["fields"])
    return {rule[k] for k in ("field", "field_to_remove") if rule.get(k)}


def required_fields(spec: dict) -> list[str]:
    """Source columns a specification reads, sorted."""
    fields: set[str] = set()
    for attribute in ATTRIBUTES:
        rule = spec.get(attribute)
        if isinstance(rule, dict) and "function" in rule:
            fields |= _function_fields(rule)
        elif isinstance(rule, list):
            fields |= set(rule)
        elif isinstance(rule, str):
            fields.add(rule)
    own = {work_column(a).lower() for a in ATTRIBUTES}
    return sorted(f for f in fields if f and f.lower() not in own)


def lower_spec(spec: dict) -> dict:
    """The specification with all field references in lower case."""

    def lowered(rule: dict) -> dict:
        out = dict(rule)
        for key in ("field", "field_to_remove"):
            if key in out:
                out[key] = out[key].lower()
        if "fields" in out:
            out["fields"] = [f.lower() for f in out["fields"]]
        if "functions" in out:
            out["functions"] = [lowered(f) for f in out["functions"]]
        return out

    out = {}
    for key, rule in spec.items():
        if isinstance(rule, str):
            out[key] = rule if rule in (X_COLUMN, Y_COLUMN) else rule.lower()
        elif isinstance(rule, list):
            out[key] = [r.lower() for r in rule]
        elif isinstance(rule, dict):
            out[key] = lowered(rule)
        else:
            out[key] = rule
    return out


def smash_case(df: DataFrame) -> DataFrame:
    """Column names in lower case, but for the reserved coordinates."""
    return df.toDF(*[c if c in (X_COLUMN, Y_COLUMN) else c.lower() for c in df.columns])
