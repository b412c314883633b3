"""Column expressions built only from Spark's own functions."""

from .fmt import decimal_mark, keyword_match, parse_decimal_mark, round_floats, round_half_even, word_match
from .timefn import epoch_micros, instant_literal, local_date, local_wall_clock, micros_to_ntz

__all__ = ["decimal_mark", "keyword_match", "parse_decimal_mark", "round_floats",
           "round_half_even", "word_match", "epoch_micros", "instant_literal", "local_date",
           "local_wall_clock", "micros_to_ntz"]
