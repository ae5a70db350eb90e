"""Column-level helpers built only from ``pyspark.sql.functions``.

Everything here returns a ``Column`` so it stays inside whole-stage codegen;
there is no Python UDF anywhere in the package.
"""

from tidepool.functions.numeric import (
    bins_between,
    ceil_long,
    nz,
    round_half_away,
    safe_div,
)
from tidepool.functions.text import clock_label, minutes_since, split_name

__all__ = [
    "bins_between",
    "ceil_long",
    "clock_label",
    "minutes_since",
    "nz",
    "round_half_away",
    "safe_div",
    "split_name",
]
