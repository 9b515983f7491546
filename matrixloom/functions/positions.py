"""The canonical positions of a feature: order, gaps, regions and halves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def labels() -> list[str]:
    """Position labels in order: -1, 0, ... 17, 17a, ... 20, 20a, 20b, ... 45, e1 ... e19, 46 ... 76."""
    out = ["-1"]
    for i in range(77):
        out.append(str(i))
        out += {17: ["17a"], 20: ["20a", "20b"], 45: [f"e{j}" for j in range(1, 20)]}.get(i, [])
    return out


#: Regions: fixed values, each with the numbers it covers, both ends included. The labels e1 to e19 are the extensionloop.
REGIONS = [
    ("fiveprime_acceptorstem", -1, 7),
    ("a_to_d_internal", 8, 9),
    ("dstem", 10, 13),
    ("dloop", 14, 21),
    ("dstem", 22, 25),
    ("d_to_anticodon_internal", 26, 26),
    ("fiveprime_anticodonstem", 27, 31),
    ("anticodonloop", 32, 38),
    ("threeprime_anticodonstem", 39, 43),
    ("anticodon_to_t_internal", 44, 48),
    ("tstem", 49, 53),
    ("tloop", 54, 60),
    ("tstem", 61, 65),
    ("threeprime_acceptorstem", 66, 76),
]


def region(label: str, compat: bool = False) -> tuple[str | None, str | None]:
    """(location, half) of a label, (None, None) if unknown. ``compat`` leaves the anticodon stem's positions unknown."""
    if label.startswith("e"):
        known = label[1:].isdigit() and 1 <= int(label[1:]) <= 19
        return ("extensionloop", "threeprime") if known else (None, None)
    number = label.rstrip("ab")
    if not number.lstrip("-").isdigit() or (number != label and label not in ("17a", "20a", "20b")):
        return None, None
    n = int(number)
    if compat and (27 <= n <= 31 or 39 <= n <= 43):
        return None, None
    for name, first, last in REGIONS:
        if first <= n <= last:
            return name, "fiveprime" if n <= 26 else "center" if n <= 43 else "threeprime"
    return None, None


def is_gap(position: Column) -> Column:
    """Insertions and the position before the first are gaps."""
    return position.rlike("a|b|e|-1")


def dimension(spark: SparkSession, compat: bool = False) -> DataFrame:
    """(position, pos_ord, gap, location, half): about a hundred rows, whatever the input."""
    rows = [(p, i, *region(p, compat)) for i, p in enumerate(labels())]
    table = spark.createDataFrame(rows, "position string, pos_ord int, location string, half string")
    return table.withColumn("gap", is_gap(F.col("position"))).select("position", "pos_ord", "gap", "location", "half")
