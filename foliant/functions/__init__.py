"""Scalar column expressions (all JVM-side built-ins, no Python UDFs)."""

from foliant.functions.columns import (  # noqa: F401
    classify_task,
    drive_link,
    first_parent,
    mb_rounded,
    output_file_name,
    path_depth,
    sanitize_name,
    size_bytes,
    strip_all,
)
