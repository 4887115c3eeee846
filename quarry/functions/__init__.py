"""Reusable column expressions; all JVM-side built-ins, no Python UDFs."""

from quarry.functions.text import tokens, has_token, present_keywords, keyword_array, dedup
from quarry.functions.geometry import assign_nearest, means_moves, nearest_index, nearest_sql, point_distance, steps
from quarry.functions.bands import working_band, sex_band, age_band, row_sum_hours

__all__ = [
    "tokens", "has_token", "present_keywords", "keyword_array", "dedup",
    "assign_nearest", "means_moves", "nearest_index", "nearest_sql", "point_distance", "steps",
    "working_band", "sex_band", "age_band", "row_sum_hours",
]
