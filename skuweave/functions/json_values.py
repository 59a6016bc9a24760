"""Values out of ``{"attribute": {"<channel>": {"<locale>": value}}}`` documents."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F, types as T

# The two scope keys every attribute is stored under.
CHANNEL = "<all_channels>"
LOCALE = "<all_locales>"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def attribute_schema(keys: Iterable[str]) -> T.StructType:
    leaf = T.StructType([T.StructField(LOCALE, T.StringType())])
    scope = T.StructType([T.StructField(CHANNEL, leaf)])
    return T.StructType([T.StructField(key, scope) for key in dict.fromkeys(keys)])


def parse_attributes(raw: Column, keys: Iterable[str], tolerant: bool = False) -> Column:
    """Parse a document once, keeping only the named attributes.

    One ``from_json`` with a narrow schema replaces one path lookup per attribute.
    Alias the result and read it with :func:`attribute_value`; Spark keeps the
    parse in its own projection because it is used more than once. A JSON ``null``
    and an absent key both give null, so the next hierarchy level is tried. A document
    that is no JSON ends the job; with ``tolerant`` it has no attributes instead.
    """
    mode = "PERMISSIVE" if tolerant else "FAILFAST"
    return F.from_json(raw, attribute_schema(keys), {"mode": mode})


def attribute_value(parsed: str, key: str) -> Column:
    """The text of one attribute of a column made by :func:`parse_attributes`."""
    return F.col(f"{quoted(parsed)}.{quoted(key)}.{quoted(CHANNEL)}.{quoted(LOCALE)}")


def json_attribute(raw: Column, key: str) -> Column:
    """Look one attribute up by path, for a single read of a document."""
    return F.get_json_object(raw, f"$['{key}']['{CHANNEL}']['{LOCALE}']")


def without_quotes(column: Column) -> Column:
    return F.replace(column, F.lit('"'), F.lit(""))
