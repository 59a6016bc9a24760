"""Fixed-format text: every field quoted, no header, fixed separator and charset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skuweave.functions.json_values import quoted

# The agreed format.
SEPARATOR = "@"
QUOTE = '"'
LINE_END = "\r\n"
# Latin-9 is Latin-1 but for eight places: what Latin-1 has there, and Latin-9 has.
_ONLY_LATIN_1 = "¤¦¨´¸¼½¾"
_ONLY_LATIN_9 = "€ŠšŽžŒœŸ"


def latin_9(text: Column) -> Column:
    """The bytes of a text in ISO-8859-15; what that has not becomes ``?``.

    Spark encodes Latin-1 by itself, so the eight other characters are set to those of the
    same place first.
    """
    same_place = F.translate(text, _ONLY_LATIN_1 + _ONLY_LATIN_9, "?" * len(_ONLY_LATIN_1) + _ONLY_LATIN_1)
    return F.encode(F.regexp_replace(same_place, r"[^\x{0}-\x{FF}]", "?"), "ISO-8859-1")


def fixed_format_line(df: DataFrame) -> Column:
    """A row as one line of the format, without its end: absent values are empty."""
    fields = []
    for name in df.columns:
        text = F.coalesce(F.col(quoted(name)).cast("string"), F.lit(""))
        fields.append(F.concat(F.lit(QUOTE), F.replace(text, F.lit(QUOTE), F.lit(QUOTE * 2)), F.lit(QUOTE)))
    return F.concat_ws(SEPARATOR, *fields)


def write_fixed_format(df: DataFrame, folder: str) -> None:
    """Write the format as one file per partition; characters outside the charset become ``?``.

    Every line is encoded by an expression and written as it is, so no setting of the
    session plays a part and writers beside each other do not disturb one another.
    """
    lines = df.select(latin_9(fixed_format_line(df)).cast("string").alias("line"))
    lines.write.option("lineSep", LINE_END).text(folder)
