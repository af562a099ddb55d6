"""Column-level helpers shared by the operators.

Everything here is a Catalyst expression, so it stays inside whole-stage
codegen; none of it runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliant.session import LINK_PREFIX, LINK_SUFFIX


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def size_bytes(col) -> Column:
    """Size as a long; missing or non-numeric values count as 0."""
    return F.coalesce(_c(col).try_cast("bigint"), F.lit(0).cast("bigint"))


def path_depth(col) -> Column:
    """Indent from a path: number of slashes minus one."""
    p = _c(col)
    return (F.length(p) - F.length(F.replace(p, F.lit("/"), F.lit("")))) - F.lit(1)


def first_parent(col="parents") -> Column:
    """First element of the parents list, null when absent or empty."""
    return F.try_element_at(_c(col), F.lit(1))


# Fixed value: the characters that ``str.strip`` takes off.
WHITE_SPACE = "\\t-\\r\\x1c-\\x20\\x85\\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def strip_all(col) -> Column:
    """Python ``str.strip()``: drop leading and trailing whitespace."""
    return F.regexp_replace(_c(col), f"^[{WHITE_SPACE}]+|[{WHITE_SPACE}]+$", "")


def sanitize_name(col) -> Column:
    """Keep letters, digits, space and underscore; then right-trim spaces."""
    return F.rtrim(F.regexp_replace(_c(col), r"[^\p{L}\p{N} _]", ""))


def mb_rounded(bytes_col) -> Column:
    """Bytes to MB with two decimals, half-even like Python ``round``."""
    return F.bround(_c(bytes_col).cast("double") / F.lit(1048576.0), 2)


def drive_link(id_col) -> Column:
    return F.concat(F.lit(LINK_PREFIX), _c(id_col), F.lit(LINK_SUFFIX))


def output_file_name(client_col, ordinal_col, fmt_col) -> Column:
    """``<client with _ for spaces>_batch_<ordinal>.<fmt>``."""
    return F.concat(F.replace(_c(client_col), F.lit(" "), F.lit("_")), F.lit("_batch_"),
                    _c(ordinal_col).cast("string"), F.lit("."), _c(fmt_col))


# Mime rules, first match wins (task_type, output_format).
MIME_RULES = [
    ("equals", ["application/pdf"], "DIRECT_INCLUDE", "pdf"),
    ("equals", ["text/plain", "text/markdown"], "DIRECT_INCLUDE", "txt"),
    ("equals", ["audio/mpeg"], "DIRECT_INCLUDE", "mp3"),
    ("contains", ["google-apps.document", "wordprocessingml"], "CONVERT", "txt"),
    ("contains", ["google-apps.spreadsheet", "spreadsheetml"], "CONVERT", "txt"),
    ("contains", ["image/"], "OCR", "pdf"),
]
FALLBACK_RULE = ("IGNORE", "none")


def classify_task(mime_col) -> Column:
    """CASE WHEN chain over the mime type -> struct(task_type, output_format)."""
    m = F.coalesce(_c(mime_col), F.lit(""))
    expr = None
    for kind, values, task_type, fmt in MIME_RULES:
        if kind == "equals":
            cond = m.isin(values)
        else:
            cond = None
            for v in values:
                c = m.contains(v)
                cond = c if cond is None else (cond | c)
        out = F.struct(F.lit(task_type).alias("task_type"), F.lit(fmt).alias("output_format"))
        expr = F.when(cond, out) if expr is None else expr.when(cond, out)
    return expr.otherwise(F.struct(F.lit(FALLBACK_RULE[0]).alias("task_type"),
                                   F.lit(FALLBACK_RULE[1]).alias("output_format")))
