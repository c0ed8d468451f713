from shelfline.functions.columns import (
    day_number,
    department,
    event_flag,
    mean_absolute_error,
    non_negative,
    root_mean_squared_error,
    version_tag,
    weekend_flag,
)

__all__ = [
    "day_number",
    "department",
    "event_flag",
    "mean_absolute_error",
    "non_negative",
    "root_mean_squared_error",
    "version_tag",
    "weekend_flag",
]
