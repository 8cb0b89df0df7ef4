"""Answers that end in a loop."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

LONGEST_UNIT = 250
BASE_REPEATS = 4
SCALING = 3.0
TRIM = 50
#: Characters at the end that decide: no unit needs more.
TAIL = 1250


def needed_repeats(unit: int, base: int = BASE_REPEATS, scaling: float = SCALING) -> int:
    """Repeats of a unit of this length that make a loop; short units need more."""
    return int(base * (1 + scaling / unit)) + 1


_NEEDED = [(u, needed_repeats(u)) for u in range(1, LONGEST_UNIT + 1)]


def ends_in_loop(text: str) -> bool:
    """Whether the end of a text is one unit over and over."""
    size = len(text)
    for unit, times in _NEEDED:
        length = unit * times
        # The last two units must agree before it is worth looking at more.
        if length <= size and text[-unit:] == text[-2 * unit : -unit] and text[-length:] == text[-unit:] * times:
            return True
    return False


def is_loop(text: str | None, cut_from_end: int = 0, trim: int = TRIM) -> bool:
    """Whether a text ends in a loop, as it stands or without its last ``trim`` characters.

    With ``cut_from_end``, only the text without that many characters is looked at. Null and empty texts do not.
    """
    if not text:
        return False
    if cut_from_end > 0:
        return ends_in_loop(text[:-cut_from_end])
    return ends_in_loop(text) or (trim > 0 and len(text) > trim and ends_in_loop(text[:-trim]))


@F.pandas_udf(BooleanType())
def _is_loop(tails: pd.Series, longer: pd.Series) -> pd.Series:
    return pd.Series(np.fromiter((is_loop(t, trim=TRIM if more else 0) for t, more in zip(tails, longer)), bool, len(tails)))


def is_degenerate(text: Column) -> Column:
    """Whether an answer ends in a loop; only its last 1300 characters leave the JVM."""
    return F.coalesce(_is_loop(F.right(text, F.lit(TAIL + TRIM)), F.coalesce(F.length(text) > TRIM, F.lit(False))), F.lit(False))
