"""Column helpers: time, numbers and text."""

from wattframe.functions.numbers import exact_mean, mean_rounded, safe_double
from wattframe.functions.times import Instant, day_of, floor_hour, ntz, part_number, trailing_cutoff, utc_naive

__all__ = ["Instant", "day_of", "exact_mean", "floor_hour", "mean_rounded", "ntz",
           "part_number", "safe_double", "trailing_cutoff", "utc_naive"]
