"""Parsing of free-text violation entries into code / description / comments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions.text import ColumnOrName, _c

# ---- fixed values: violation text patterns ----------------------------------------
# delimited style: "12. DESCRIPTION - Comments: free text"
DELIMITED_CODE = r"^(\d+)\."
DELIMITED_DESC = r"^\d+\.\s*(.+?)(?:\s*-\s*Comments:.*)?$"
DELIMITED_COMMENTS = r"-\s*Comments:\s*(.*)"
DELIMITED_CODE_PREFIX = r"^\d+\.\s*"
# slot style: "*39 Description" (code anywhere, first digits followed by whitespace)
SLOT_CODE = r"\*?(\d+)\s"
SLOT_DESC = r"\*?\d+\s+(.*)"
# -----------------------------------------------------------------------------------


def _dotall(p: str, dotall: bool) -> str:
    return "(?s)" + p if dotall else p


def delimited_parts(raw: ColumnOrName, fallback: bool = True, dotall: bool = False) -> dict[str, Column]:
    """code / description / comments of a delimited entry.

    Without ``dotall`` '.' stops at a newline, so a multi-line comment yields an empty
    description and only the first comment line (source behaviour). With ``fallback`` a
    missing code becomes NULL and an empty description falls back to the raw text minus
    its leading 'N.'.
    """
    r = _c(raw)
    code = F.regexp_extract(r, DELIMITED_CODE, 1)
    desc = F.trim(F.regexp_extract(r, _dotall(DELIMITED_DESC, dotall), 1))
    comments = F.trim(F.regexp_extract(r, _dotall(DELIMITED_COMMENTS, dotall), 1))
    if fallback:
        code = F.nullif(code, F.lit(""))
        desc = F.when(desc == "", F.trim(F.regexp_replace(r, DELIMITED_CODE_PREFIX, ""))).otherwise(desc)
    return {"violation_code": code, "violation_description": desc, "violation_comments": comments}


def slot_parts(raw: ColumnOrName, fallback: bool = True) -> dict[str, Column]:
    """code / description of a slot entry like '*39 Food contact surfaces'."""
    r = _c(raw)
    code = F.regexp_extract(r, SLOT_CODE, 1)
    desc = F.trim(F.regexp_extract(r, SLOT_DESC, 1))
    if fallback:
        code = F.nullif(code, F.lit(""))
        desc = F.when(desc == "", F.trim(r)).otherwise(desc)
    return {"violation_code": code, "violation_description": desc}
