"""Marker normalisation of a wide cell × marker table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tissuegrid.functions import rows

KEY = "cell_mask_id"
IDENTIFIERS = ("patch_id", "global_cell_id")


def strip_identifiers(df: DataFrame) -> DataFrame:
    """Drop patch and global ids; the mask id stays as the row key."""
    return df.drop(*IDENTIFIERS)


def marker_columns(df: DataFrame, key: str = KEY) -> list[str]:
    return [c for c in df.columns if c != key and c not in IDENTIFIERS]


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Anything that is not a number, NaN included, becomes NULL."""
    kinds = dict(df.dtypes)

    def clean(name: str) -> Column:
        c = F.col(f"`{name}`")
        c = c.try_cast("double") if kinds[name] == "string" else c.cast("double")
        return F.when(~F.isnan(c), c).alias(name)

    wanted = set(columns)
    return df.select(*[clean(c) if c in wanted else F.col(f"`{c}`") for c in df.columns])


def complete_cases(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Numeric coercion, then rows with every marker known."""
    columns = list(columns or marker_columns(df))
    return coerce_numeric(df, columns).na.drop("any", subset=columns)


def drop_empty_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop markers without any value, then incomplete rows. Counts come from one small aggregate."""
    known = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in columns]).first().asDict()
    empty = [c for c in columns if known[c] == 0]
    kept = [c for c in columns if known[c] > 0]
    return df.drop(*empty).na.drop("any", subset=kept)


def column_moments(df: DataFrame, columns: Sequence[str], sample: bool, value: Callable = lambda c: c) -> Column:
    """Mean and deviation per marker as one scalar subquery row."""
    sd = F.stddev_samp if sample else F.stddev_pop
    fields = []
    for c in columns:
        v = value(F.col(f"`{c}`"))
        fields += [F.avg(v).alias(f"mean_{c}"), sd(v).alias(f"sd_{c}")]
    return df.agg(F.struct(*fields).alias("moments")).scalar()


def zscore_columns(df: DataFrame, columns: Sequence[str], sample: bool = False, value: Callable = lambda c: c) -> DataFrame:
    """Column z-score with global moments; constant columns give NULL."""
    moments = column_moments(df, columns, sample, value)
    wanted = set(columns)
    out = []
    for c in df.columns:
        if c in wanted:
            centred = value(F.col(f"`{c}`")) - moments.getField(f"mean_{c}")
            out.append(F.try_divide(centred, moments.getField(f"sd_{c}")).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return df.select(*out)


def map_rows(df: DataFrame, columns: Sequence[str], text: Callable[[str], str]) -> DataFrame:
    """Apply a row function given as SQL text over the marker array and spread it back to columns."""
    others = [c for c in df.columns if c not in set(columns)]
    packed = df.select(*[F.col(f"`{c}`") for c in others], F.array(*[F.col(f"`{c}`") for c in columns]).alias("_v"))
    mapped = packed.select(*others, F.expr(text("_v")).alias("_w"))
    return mapped.select(*others, *[F.col("_w")[i].alias(c) for i, c in enumerate(columns)])


def _double_z(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    z = zscore_columns(df, columns, sample=False)
    z = map_rows(z, columns, rows.zscore_row)
    return map_rows(z, columns, rows.upper_tail_log)


NORMALISERS: dict[str, Callable[[DataFrame, Sequence[str]], DataFrame]] = {
    "none": lambda df, m: df,
    "log1p": lambda df, m: map_rows(df, m, rows.log1p),
    "zscore_log": lambda df, m: zscore_columns(df, m, sample=True, value=F.log1p),
    "clr": lambda df, m: map_rows(df, m, rows.centred_log_ratio),
    "double_z": _double_z,
    "rank_fraction": lambda df, m: map_rows(df, m, rows.rank_fraction),
    "rank_gaussian": lambda df, m: map_rows(df, m, rows.rank_gaussian),
    "rank_fraction_ordinal": lambda df, m: map_rows(df, m, lambda v: rows.rank_fraction(v, True)),
    "rank_gaussian_ordinal": lambda df, m: map_rows(df, m, lambda v: rows.rank_gaussian(v, True)),
}


def prepare(df: DataFrame, norm: str = "log1p", key: str = KEY) -> DataFrame:
    """Strip ids, coerce, keep complete rows and normalise by name."""
    if norm not in NORMALISERS:
        raise ValueError(f"unknown normalisation {norm!r}; choose from {sorted(NORMALISERS)}")
    plain = strip_identifiers(df)
    markers = marker_columns(plain, key)
    return NORMALISERS[norm](complete_cases(plain, markers), markers)


def marker_entropy(df: DataFrame, columns: Sequence[str], base: float = 2.0, zero_row: float | None = 0.0, name: str = "cell_entropy") -> DataFrame:
    packed = df.withColumn("_v", F.array(*[F.col(f"`{c}`").cast("double") for c in columns]))
    return packed.withColumn(name, F.expr(rows.entropy("_v", base, zero_row))).drop("_v")


def add_entropy(meta: DataFrame, expression: DataFrame, columns: Sequence[str], key: str = KEY) -> DataFrame:
    """Entropy joined to metadata unless it is there already."""
    if "cell_entropy" in meta.columns:
        return meta
    scores = marker_entropy(expression, columns, zero_row=None).select(key, "cell_entropy")
    return meta.join(scores, key, "left")


def entropy_bounds(n_channels: int) -> tuple[Column, Column]:
    return F.lit(0.0), F.log2(F.lit(float(n_channels)))


def to_long(df: DataFrame, columns: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """(ids, feature, v): the canonical shape for panels of any width."""
    typed = df.select(*ids, *[F.col(f"`{c}`").cast(T.DoubleType()).alias(c) for c in columns])
    return typed.unpivot(list(ids), list(columns), "feature", "v")
