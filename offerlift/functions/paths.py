"""Expressions over artifact paths and object identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerlift.functions.timestamps import parse_iso, time_suffix


def path_part(path: Column, position: int) -> Column:
    """1-based part of a path; negative positions count from the end."""
    return F.try_element_at(F.split(path, "/"), F.lit(position))


def last_segment(path: Column) -> Column:
    return path_part(path, -1)


def replace_last_segment(path: Column, segment: Column) -> Column:
    return F.concat(F.regexp_replace(path, "[^/]+$", ""), segment)


def normalize_location(path: Column) -> Column:
    """Rewrite a last segment holding an ISO time as its 14-digit suffix.

    Paths whose last segment is not a time are left as they are.
    """
    suffix = time_suffix(parse_iso(last_segment(path)))
    return F.coalesce(replace_last_segment(path, suffix), path)


def strip_uid(text: Column) -> Column:
    return F.regexp_replace(text, "^uid=", "")


def uid_name(uid: Column) -> Column:
    """``PipelineModel`` of ``PipelineModel_4f1c``."""
    return F.split(uid, "_")[0]


def uid_code(uid: Column) -> Column:
    """``4f1c`` of ``PipelineModel_4f1c``."""
    return F.try_element_at(F.split(uid, "_"), F.lit(2))


def artifact_path(root: str, suffix: Column) -> Column:
    return F.format_string("%s/%s", F.lit(root.rstrip("/")), suffix)
