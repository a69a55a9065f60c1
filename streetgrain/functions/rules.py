"""Rules over event payloads, logs, source definitions and run states."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from streetgrain.schema import RUN_STATE_KEYS

# Fixed value: a comment that asks for another run.
RERUN_COMMENT = r"(?im)^re-?run this,? please\b"

# Problems of a source, and the log lines that reveal them, in
# order of precedence.
LOG_PROBLEMS = [
    ("WARNING: A source test failed", "An acceptance test failed"),
    ("WARNING: Source is missing a conform object", "Source is missing a conform object"),
    ("WARNING: Unknown source conform protocol", "Unknown source conform protocol"),
    ("WARNING: Unknown source conform format", "Unknown source conform format"),
    ("WARNING: Unknown source conform type", "Unknown source conform type"),
    ("WARNING: Found no addresses in source data", "Found no addresses in source data"),
    ("WARNING: Could not download source data", "Could not download source data"),
    ("WARNING: Error doing conform; skipping", "Could not conform source data"),
    (
        "WARNING: Could not download ESRI source data: Could not retrieve layer metadata: Token Required",
        "Missing required ESRI token",
    ),
]
NO_COVERAGE = "Missing or incomplete coverage"
SKIPPED = "Source says to skip"
COVERAGE_KEYS = ["ISO 3166", "US Census", "geometry"]


def _yes(column: Column) -> Column:
    return F.coalesce(column, F.lit(False))


def _has_all(payload: Column, *keys: str) -> Column:
    present = F.json_object_keys(payload)
    return _yes(F.size(F.array_intersect(present, F.array(*[F.lit(k) for k in keys]))) == len(keys))


def _rerun_comment(payload: Column) -> Column:
    in_request = _has_all(F.get_json_object(payload, "$.issue"), "pull_request")
    return in_request & _yes(F.get_json_object(payload, "$.comment.body").rlike(RERUN_COMMENT))


def event_skip(event: Column, payload: Column) -> Column:
    """Whether an event should not start any work."""
    action = F.get_json_object(payload, "$.action")
    return (
        F.when(_yes(event == "pull_request") & _has_all(payload, "action"), _yes(action == "closed"))
        .when(
            _has_all(payload, "commits", "head_commit"),
            _yes(F.get_json_object(payload, "$.deleted") == "true"),
        )
        .when(
            _has_all(payload, "action", "comment", "issue"),
            _yes(action == "deleted") | ~_rerun_comment(payload),
        )
        .otherwise(F.lit(True))
    )


def event_rerun(payload: Column) -> Column:
    """Whether an event asks to run a source again."""
    comment = _has_all(payload, "action", "comment", "issue")
    deleted = _yes(F.get_json_object(payload, "$.action") == "deleted")
    return comment & ~deleted & _rerun_comment(payload)


def source_file_path(path: Column) -> Column:
    """A JSON file below the sources folder."""
    return path.startswith("sources/") & path.endswith(".json")


def coverage_complete(definition: Column) -> Column:
    """The coverage of a definition names a place or carries a geometry."""
    keys = F.json_object_keys(F.get_json_object(definition, "$.coverage"))
    return _yes(F.arrays_overlap(keys, F.array(*[F.lit(k) for k in COVERAGE_KEYS])))


def source_problem(log: Column, definition: Column, skipped: Column | None = None) -> Column:
    """First problem a log reveals; a coverage problem if there is none."""
    found = F.coalesce(*[F.when(_yes(log.contains(t)), F.lit(p)) for t, p in LOG_PROBLEMS])
    found = F.coalesce(found, F.when(~coverage_complete(definition), F.lit(NO_COVERAGE)))
    return found if skipped is None else F.when(_yes(skipped), F.lit(SKIPPED)).otherwise(found)


def conform_type(cache: Column, geometry_type: Column) -> Column:
    """Kind of source data by the extension of its cached file."""
    polygon = _yes(geometry_type.isin("Polygon", "MultiPolygon"))
    return (
        F.when(cache.endswith(".zip") & polygon, F.lit("shapefile-polygon"))
        .when(cache.endswith(".zip"), F.lit("shapefile"))
        .when(cache.endswith(".json"), F.lit("geojson"))
        .when(cache.endswith(".csv"), F.lit("csv"))
    )


def state_value(state: Column, key: str) -> Column:
    """One value of a run state document, as text."""
    return F.get_json_object(state, f"$['{key}']")


def unknown_state_keys(state: Column) -> Column:
    """Keys that a run state may not have."""
    allowed = F.array(*[F.lit(k) for k in RUN_STATE_KEYS])
    return F.array_except(F.json_object_keys(state), allowed)


def upgrade_source_schema(definition: Column) -> Column:
    """A flat definition wrapped as the only address layer of a layered one.

    The coverage moves to the top; the layer is called ``primary`` unless the
    definition has a name. Documents with ``schema`` or ``layers`` stay as
    they are.
    """
    members = F.from_json(definition, "map<string,variant>")
    layer = F.map_filter(members, lambda k, v: k != "coverage")
    name = F.create_map(F.lit("name"), F.parse_json(F.lit('"primary"')))
    name = F.map_filter(name, lambda k, v: ~F.map_contains_key(layer, k))
    wrapped = F.to_json(
        F.struct(
            F.struct(F.array(F.map_concat(name, layer)).alias("addresses")).alias("layers"),
            F.try_element_at(members, F.lit("coverage")).alias("coverage"),
        )
    )
    keys = F.json_object_keys(definition)
    layered = F.arrays_overlap(keys, F.array(F.lit("schema"), F.lit("layers")))
    return F.when(layered, definition).otherwise(wrapped)
