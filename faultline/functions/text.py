"""Text clean-up used by the field-log and report operators."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from faultline.functions.numeric import column
from faultline.schemas import EXTRACTED_FIELDS

# Pieces removed before a spoken option is compared, in order.
SPOKEN_NOISE = ["-", "udi", "m"]

# Markup removed from generated text before it is shown.
MARKUP = ["**", "##", "```"]


def clean_name(name: str) -> str:
    """Column name in lower case with runs of other characters as one '_'."""
    return re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")


def spoken_form(value) -> Column:
    """Comparable form of an option or a spoken phrase."""
    out = F.lower(column(value))
    for piece in SPOKEN_NOISE:
        out = F.replace(out, F.lit(piece), F.lit(""))
    return F.btrim(out, F.lit(" \t\r\n\f\v"))


def strip_markup(value) -> Column:
    out = column(value)
    for piece in MARKUP:
        out = F.replace(out, F.lit(piece), F.lit(""))
    return out


def strip_code_fence(value) -> Column:
    """JSON text without a surrounding ```json fence."""
    out = F.replace(column(value), F.lit("```json"), F.lit(""))
    return F.btrim(F.replace(out, F.lit("```"), F.lit("")), F.lit(" \t\r\n\f\v"))


def report_struct(json_text) -> Column:
    """The seven report fields of a JSON object and ``_corrupt_record``.

    Every field is read as text, so a number in quotes is no parse error.
    """
    fields = ", ".join(f"{name} string" for name in EXTRACTED_FIELDS)
    return F.from_json(
        column(json_text),
        f"{fields}, _corrupt_record string",
        {
            "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": "_corrupt_record",
            "allowSingleQuotes": "false",
        },
    )


def is_report_object(json_text, parsed) -> Column:
    """True when ``parsed`` came from one JSON object.

    Malformed text yields a struct of nulls rather than a null struct, so the
    corrupt-record field decides. The parser stops behind the first object;
    that nothing follows it is tested by reading the text as an array's only item.
    """
    json_text, parsed = column(json_text), column(parsed)
    alone = F.from_json(
        F.concat(F.lit("["), json_text, F.lit("]")), "array<string>", {"allowSingleQuotes": "false"}
    )
    whole = json_text.startswith("{") & (F.size(alone) == 1)
    return F.coalesce(whole & parsed["_corrupt_record"].isNull(), F.lit(False))


def shortened(value, limit: int = 300) -> Column:
    """Text cut at ``limit`` characters with an ellipsis when it is longer."""
    value = column(value)
    return F.when(
        F.length(value) > limit, F.concat(F.substring(value, 1, limit), F.lit("…"))
    ).otherwise(value)


def blank_to_null(value) -> Column:
    value = column(value)
    return F.when(F.btrim(value, F.lit(" \t\r\n\f\v")) != "", value)
