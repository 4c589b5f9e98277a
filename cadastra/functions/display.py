"""Values as they are shown: popup fields, value classes and colours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Colour stops of the three value scales and the colour of a missing value.
SCALES = {
    "map": [
        (0, "#3b82f6"), (100000, "#6366f1"), (500000, "#8b5cf6"), (2000000, "#f59e0b"), (10000000, "#ef4444"),
    ],
    "style": [
        (0, "#eff6ff"), (100000, "#bfdbfe"), (250000, "#60a5fa"), (500000, "#2563eb"), (1000000, "#7c3aed"),
        (5000000, "#f59e0b"), (20000000, "#ef4444"),
    ],
    "raw": [
        (0, "#f7fbff"), (100000, "#c6dbef"), (250000, "#6baed6"), (500000, "#2171b5"), (1000000, "#08306b"),
    ],
}
MISSING = {"map": "#6366f1", "style": "#6c63ff", "raw": "#6c63ff"}


def to_number(value: Column) -> Column:
    """Number of a value, 0 when it is missing or not a number."""
    return F.coalesce(value.try_cast("double"), F.lit(0.0))


def value_class(value: Column, scale: str = "map") -> Column:
    """Lower stop of the class a value falls in; values below the first stop join it, null stays null."""
    stops = [s for s, _ in SCALES[scale]]
    result = F.lit(stops[0])
    for stop in stops[1:]:
        result = F.when(value >= stop, F.lit(stop)).otherwise(result)
    return F.when(value.isNotNull(), result.cast("bigint"))


def value_color(value: Column, scale: str = "map") -> Column:
    """Colour on the linear scale between stops as '#rrggbb'; a missing value gets the scale's default."""
    stops = SCALES[scale]
    number = to_number(value)

    def channel(at: int) -> Column:
        levels = [int(color[at : at + 2], 16) for _, color in stops]
        result = F.lit(float(levels[-1]))
        for i in range(len(stops) - 2, -1, -1):
            (s0, _), (s1, _) = stops[i], stops[i + 1]
            inside = F.lit(float(levels[i])) + (number - s0) * (levels[i + 1] - levels[i]) / F.lit(float(s1 - s0))
            result = F.when(number < s1, inside).otherwise(result)
        result = F.when(number <= stops[0][0], F.lit(float(levels[0]))).otherwise(result)
        return F.lpad(F.lower(F.hex(F.floor(result + 0.5).cast("bigint"))), 2, "0")

    color = F.concat(F.lit("#"), channel(1), channel(3), channel(5))
    return F.when(value.isNull(), F.lit(MISSING[scale])).otherwise(color)


def text_or(default: str, *values: Column) -> Column:
    """First value that is neither null nor empty, else the default."""
    return F.coalesce(*[F.nullif(v.cast("string"), F.lit("")) for v in values], F.lit(default))


def money_or_na(*values: Column) -> Column:
    """'$1,234' of the first value that is neither null nor zero, else 'N/A'."""
    amount = F.coalesce(*[F.nullif(v.cast("bigint"), F.lit(0).cast("bigint")) for v in values])
    return F.coalesce(F.concat(F.lit("$"), F.format_number(amount, 0)), F.lit("N/A"))


def label(value: Column) -> Column:
    """Label text: null shows as nothing."""
    return F.coalesce(value, F.lit(""))


def extent_text(b: Column) -> Column:
    """'xmin, ymin .. xmax, ymax' with two decimals, '--' without an extent."""
    text = F.format_string("%.2f, %.2f .. %.2f, %.2f", b["xmin"], b["ymin"], b["xmax"], b["ymax"])
    return F.when(b["xmin"].isNotNull(), text).otherwise(F.lit("--"))
