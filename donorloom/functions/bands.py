"""Amount, recency and frequency bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Inclusive upper bound -> label.
MONETARY = {
    4: "A: 0-4.99",
    9: "B: 5-9.99",
    14: "C: 10-14.99",
    19: "D: 15-19.99",
    24: "E: 20-24.99",
    49: "F: 25-49.99",
    99: "G: 50-99.99",
    249: "H: 100-249.99",
    499: "I: 250-499.99",
    999: "J: 500-999.99",
    2499: "K: 1000-2499.99",
    4999: "L: 2500-4999.99",
    9999: "M: 5000-9999.99",
    9999999: "N: 10000+",
}
FREQUENCY = {1: "A: 1 Gift", 2: "B: 2 Gifts", 4: "C: 3-4 Gifts", 9: "D: 5-9 Gifts", 100000: "E: 10+ Gifts"}
RECENCY = {
    3: "A: 0-3",
    6: "B: 4-6",
    12: "C: 7-12",
    18: "D: 13-18",
    24: "E: 19-24",
    36: "F: 25-36",
    48: "G: 37-48",
    60: "H: 49-60",
    72: "I: 61-72",
    84: "J: 73-84",
    96: "K: 85-96",
    108: "L: 97-108",
    120: "M: 109-120",
    132: "N: 121-132",
    144: "O: 133-144",
    500000: "P: 145+",
}
# Code letters of a finer scheme.
RECENCY_LETTERS = {
    "A": "0-3 months", "B": "4-6 months", "C": "7-9 months", "D": "10-12 months", "E": "13-18 months",
    "F": "19-24 months", "G": "25-30 months", "H": "31-36 months", "I": "37-42 months", "J": "43-48 months",
    "K": "49-60 months", "L": "61-72 months", "M": "73-84 months", "N": "85-96 months", "O": "97-108 months",
    "P": "109-120 months", "Q": "121-144 months", "R": "145+ months",
}
FREQUENCY_LETTERS = {
    "A": "1 gift", "B": "2 gifts", "C": "3 gifts", "D": "4 gifts", "E": "5 gifts",
    "F": "6 gifts", "G": "7 gifts", "H": "8 gifts", "I": "9 gifts", "J": "10+ gifts",
}
MONETARY_LETTERS = {
    "A": "<$2", "B": "$2-$4.99", "C": "$5-$9.99", "D": "$10-$14.99", "E": "$15-$19.99", "F": "$20-$24.99",
    "G": "$25-$49.99", "H": "$50-$99.99", "I": "$100-$249.99", "J": "$250-$499.99", "K": "$500-$999.99",
    "L": "$1,000+",
}


def upper_bound_band(value: Column, bands: Mapping[int, str], missing: str | None) -> Column:
    """Label of the first band whose upper bound reaches the value."""
    label = None
    for bound, text in sorted(bands.items()):
        label = F.when(value <= bound, text) if label is None else label.when(value <= bound, text)
    return label.otherwise(F.lit(missing))


def gift_level(amount: Column, missing: str = "No GiftLevelID") -> Column:
    """Monetary band of the whole-dollar amount; below 1 counts as 1."""
    return upper_bound_band(F.greatest(F.floor(amount), F.when(amount.isNotNull(), F.lit(1))), MONETARY, missing)


def frequency_band(gifts: Column, missing: str = "Z: NoFreqid") -> Column:
    return upper_bound_band(gifts, FREQUENCY, missing)


def recency_band(months: Column, missing: str = "Z: NoMRCid") -> Column:
    return upper_bound_band(months, RECENCY, missing)


def amount_flag(amount: Column, limit: float = 10000, low: str = "<$10,000", high: str = ">=$10,000") -> Column:
    return F.when(amount < limit, low).otherwise(high)


def interval_label(
    value: Column, intervals: Sequence[tuple[float, float, str]], closed: str = "left", missing: str = "Z: NoAmt",
) -> Column:
    """Label of the interval that holds the value; ``closed`` is left or both."""
    label = F.lit(None).cast("string")
    for low, high, text in reversed(intervals):
        inside = (value >= low) & ((value < high) if closed == "left" else (value <= high))
        label = F.when(inside, text).otherwise(label)
    return F.coalesce(label, F.lit(missing))


def letter_label(letter: Column, labels: Mapping[str, str]) -> Column:
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), letter)


def years_on_file(start: Column, first_gift: Column) -> Column:
    years = F.floor(F.datediff(start, first_gift) / 365)
    label = (F.when(years == 1, "1st Year").when(years == 2, "2nd Year").when(years == 3, "3rd Year")
             .when(years == 4, "4th Year").when(years >= 5, "5+ Years"))
    return label.otherwise("No Giving")


def new_or_existing(group: Column) -> Column:
    return F.when(group == "New", "New").when(group == "No Giving History", "(blank)").otherwise("Existing")


def months_status(months: Column) -> Column:
    """Recurring-donor status from months since the last recurring gift."""
    return (F.when(months == 0, "Active").when(months.between(1, 5), "Lapsing- Short")
            .when(months.between(6, 11), "Lapsing-Long").when(months >= 12, "Lapsed").otherwise("N/A"))
