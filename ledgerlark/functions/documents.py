"""JSON text and XML text read with a declared shape."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_struct(column: Column, shape: str) -> Column:
    """NULL text gives NULL; broken text gives a struct of NULLs."""
    return F.from_json(column, shape)


def json_tags(column: Column, key: str = "Tags") -> Column:
    """The string array below ``key``; NULL when it is missing."""
    return F.from_json(F.get_json_object(column, f"$.{key}"), "array<string>")


def xml_struct(column: Column, shape: str) -> Column:
    return F.from_xml(column, shape)


def xml_text(struct: Column, row_tag: str) -> Column:
    return F.to_xml(struct, {"rowTag": row_tag, "nullValue": ""})


def nested(tag_shapes: dict[str, Column]) -> Column:
    """A struct out of slash-separated element paths ('Period/From_date')."""
    groups: dict[str, dict[str, Column] | Column] = {}
    for path, column in tag_shapes.items():
        head, _, rest = path.partition("/")
        if rest:
            groups.setdefault(head, {})[rest] = column
        else:
            groups[head] = column
    return F.struct(
        *[(nested(value) if isinstance(value, dict) else value).alias(tag) for tag, value in groups.items()]
    )
