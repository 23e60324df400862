"""Small text functions: labels, file names, sizes, flags and channel keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings.
TRUE_WORDS = ("true", "t", "yes", "y", "1", "on")
FALSE_WORDS = ("false", "f", "no", "n", "0", "off")
NULL_WORDS = ("", "null", "none")


def safe_label(idx: Column, name: Column, class_name: Column, position: Column) -> Column:
    """First known of idx, name, class name and position, whole numbers without a fraction, odd characters as ``_``."""
    whole = F.when(idx.rlike(r"^[+-]?\d+\.0+$"), F.regexp_replace(idx, r"\.0+$", "")).otherwise(idx)
    chosen = F.trim(F.coalesce(whole, name, class_name, position.cast("string")))
    filled = F.when(chosen == "", position.cast("string")).otherwise(chosen)
    return F.regexp_replace(filled, r"[^\p{L}\p{N}_-]", "_")


def safe_filename(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\w-]", "_")


def human_size(size: Column) -> Column:
    """Bytes in steps of 1024 with one decimal."""
    units = ["B", "KB", "MB", "GB", "TB"]

    def shown(power: int) -> Column:
        # Ties go to the even digit, as in the printed reports.
        return F.bround(size.cast("double") / F.lit(1024.0**power), 1)

    out = F.format_string("%.1f PB", shown(len(units)))
    for i, unit in reversed(list(enumerate(units))):
        out = F.when(size < 1024.0 ** (i + 1), F.format_string(f"%.1f {unit}", shown(i))).otherwise(out)
    return out


def thousands(n: Column) -> Column:
    return F.coalesce(F.format_number(n, 0), F.lit("-"))


def minute_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm")


def area_um2(pixels: Column, mpp: float = 0.5) -> Column:
    return pixels * F.lit(mpp * mpp)


def per_hundred_um2(n: Column, pixels: Column, nm_y: float = 377.5, nm_x: float = 377.5) -> Column:
    """Objects per 100 µm² of ``pixels`` pixels of the given size."""
    return F.try_divide(n.cast("double"), pixels * F.lit(nm_y * nm_x / 1e6)) * 100


def image_of_tile(filename: Column) -> Column:
    stem = F.regexp_replace(F.element_at(F.split(filename, "/"), -1), r"\.[^.]*$", "")
    return F.split_part(stem, F.lit("_"), F.lit(1))


def channel_number(key: Column) -> Column:
    return F.element_at(F.split(key, ":"), -1).try_cast("int")


def parse_bool(c: Column) -> Column:
    """True, false or NULL for text that is neither."""
    word = F.lower(F.trim(c))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def is_null_word(c: Column) -> Column:
    return c.isNull() | F.lower(F.trim(c)).isin(*NULL_WORDS)


def one_based(cluster: Column) -> Column:
    return (cluster + 1).cast("string")
