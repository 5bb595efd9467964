"""JSON predicate hints as Spark columns."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hint value types and the Spark type of each.
VALUE_TYPES = {
    "bool": "boolean",
    "int": "int",
    "long": "bigint",
    "float": "float",
    "double": "double",
    "string": "string",
    "date": "date",
    "timestamp": "timestamp_ntz",
}

_COMPARE = {
    "equal": lambda a, b: a == b,
    "lessThan": lambda a, b: a < b,
    "lessThanOrEqual": lambda a, b: a <= b,
    "greaterThan": lambda a, b: a > b,
    "greaterThanOrEqual": lambda a, b: a >= b,
}


def hint_to_column(hint: str | dict) -> Column:
    """Turn a hint tree (as text or parsed) into a boolean column.

    Literals are cast, columns are not: a cast on the column side would hide the comparison from
    the Parquet reader.
    """
    node = json.loads(hint) if isinstance(hint, str) else hint
    op = node["op"]
    if op == "column":
        return F.col(node["name"])
    if op == "literal":
        return F.lit(node["value"]).cast(VALUE_TYPES[node["valueType"]])
    children = [hint_to_column(child) for child in node["children"]]
    if op in _COMPARE:
        left, right = children
        return _COMPARE[op](left, right)
    if op == "and":
        return reduce(lambda a, b: a & b, children)
    if op == "or":
        return reduce(lambda a, b: a | b, children)
    if op == "not":
        return ~children[0]
    if op == "isNull":
        return children[0].isNull()
    raise ValueError(f"unknown hint operator: {op}")
