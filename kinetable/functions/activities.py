"""Activity codes of the public phone-and-watch activity dataset."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The published code table of the dataset (there is no code N).
ACTIVITY_NAMES = {
    "A": "Walking",
    "B": "Jogging",
    "C": "Stairs",
    "D": "Sitting",
    "E": "Standing",
    "F": "Typing",
    "G": "Brushing teeth",
    "H": "Eating soup",
    "I": "Eating chips",
    "J": "Eating pasta",
    "K": "Drinking",
    "L": "Eating sandwich",
    "M": "Kicking",
    "O": "Catching",
    "P": "Dribbling",
    "Q": "Writing",
    "R": "Clapping",
    "S": "Folding clothes",
}


def activity_name(code: Column) -> Column:
    """Readable activity name; an unknown code is returned as it is."""
    table = F.create_map(*(F.lit(part) for pair in ACTIVITY_NAMES.items() for part in pair))
    return F.coalesce(F.try_element_at(table, code), code)
