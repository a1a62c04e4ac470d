from feedlake.functions.days import (
    default_bounds,
    load_window,
    midnight_literal,
    midnight_text,
    parse_day,
)

__all__ = ["default_bounds", "load_window", "midnight_literal", "midnight_text", "parse_day"]
