"""Names and numeric codes of the query settings."""

# Every code below is part of the query contract and must keep
# its number, because stored query logs carry the numbers.
MATCH_MODES = {
    "all": 0,
    "any": 1,
    "phrase": 2,
    "boolean": 3,
    "extended": 4,
    "fullscan": 5,
    "extended2": 6,
}
RANKERS = {
    "proximity_bm25": 0,
    "bm25": 1,
    "none": 2,
    "wordcount": 3,
    "proximity": 4,
    "matchany": 5,
    "fieldmask": 6,
    "boosted": 7,
    "expr": 8,
}
SORT_MODES = {
    "relevance": 0,
    "attr_desc": 1,
    "attr_asc": 2,
    "time_segments": 3,
    "extended": 4,
    "expr": 5,
}
FILTER_TYPES = {"values": 0, "range": 1, "float_range": 2}
GROUP_FUNCTIONS = {
    "day": 0,
    "week": 1,
    "month": 2,
    "year": 3,
    "attr": 4,
    "attrpair": 5,
}
STATUS = {"ok": 0, "error": 1, "retry": 2, "warning": 3}

# Attribute type names and the Spark type that holds them
# (unsigned 32-bit numbers need a bigint).
ATTRIBUTE_TYPES = {
    "integer": "bigint",
    "timestamp": "timestamp",
    "ordinal": "bigint",
    "bool": "boolean",
    "float": "float",
    "bigint": "bigint",
    "string": "string",
    "multi": "array<bigint>",
    "multi64": "array<bigint>",
}

# Limits and defaults of a query.
DEFAULT_OFFSET = 0
DEFAULT_LIMIT = 20
DEFAULT_MAX_MATCHES = 1000
PAGE_BOUND = 16777216  # offset and limit stay below this
WEIGHT_BOUND = 4294967295  # the minor part of a packed weight stays within this


def code_name(table: dict[str, int], value: str | int) -> str:
    """Name of a setting given either its name or its code."""
    if isinstance(value, str) and value in table:
        return value
    for name, code in table.items():
        if code == value and not isinstance(value, (str, bool)):
            return name
    raise ValueError(f"{value!r} is none of {table}")
