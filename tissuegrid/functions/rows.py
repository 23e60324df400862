"""Row-local marker arithmetic on an ``array<double>`` column, as SQL text.

Arrays keep one expression per operator however many markers there are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tissuegrid.functions.special import normal_cdf_sql, normal_quantile_sql, number


def _sum(array: str) -> str:
    return f"aggregate({array}, {number(0)}, (s, x) -> s + x)"


def _bound(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is worked out once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def average_ranks(v: str) -> str:
    """Rank of each entry within the row, ties averaged."""
    return (
        f"transform({v}, a -> size(filter({v}, b -> b < a))"
        f" + (size(filter({v}, b -> b = a)) + 1) / {number(2)})"
    )


def ordinal_ranks(v: str) -> str:
    """Rank of each entry within the row, ties broken by position."""
    return (
        f"transform({v}, (a, i) -> CAST(size(filter({v}, (b, j) -> b < a OR (b = a AND j <= i))) AS DOUBLE))"
    )


def rank_fraction(v: str, ordinal: bool = False) -> str:
    ranks = ordinal_ranks(v) if ordinal else average_ranks(v)
    return f"transform({ranks}, r -> r / (size({v}) + 1))"


def rank_gaussian(v: str, ordinal: bool = False) -> str:
    return f"transform({rank_fraction(v, ordinal)}, p -> {normal_quantile_sql('p')})"


def log1p(v: str) -> str:
    return f"transform({v}, x -> log1p(x))"


def centred_log_ratio(v: str) -> str:
    """log1p(v / geometric mean of the non-zero entries); all-zero rows give NULL entries."""
    logs = "transform(filter(r, x -> x <> 0), x -> ln(x))"
    scaled = "transform(r, x -> log1p(try_divide(x, g)))"
    return _bound(v, "r", _bound(logs, "l", _bound(f"exp(try_divide({_sum('l')}, size(l)))", "g", scaled)))


def zscore_row(v: str) -> str:
    """Population z-score within the row; constant rows give NULL entries."""
    deviation = f"sqrt({_sum('transform(r, y -> power(y - m, 2))')}/size(r))"
    scaled = "transform(r, x -> try_divide(x - m, d))"
    return _bound(v, "r", _bound(f"({_sum('r')}/size(r))", "m", _bound(deviation, "d", scaled)))


def upper_tail_log(v: str) -> str:
    """−ln(1 − Φ(z)), Φ clipped below one."""
    return f"transform({v}, z -> -ln(1 - least({normal_cdf_sql('z')}, {number(1 - 1e-12)})))"


def entropy(v: str, base: float = 2.0, zero_row: float | None = 0.0) -> str:
    """Shannon entropy of the row taken as a distribution; ``zero_row`` when its sum is not positive."""
    zero = "CAST(NULL AS DOUBLE)" if zero_row is None else number(zero_row)
    terms = f"transform(filter(r, x -> x > 0), x -> -(x/t)*ln(x/t)/ln({number(base)}))"
    return _bound(v, "r", _bound(_sum("r"), "t", f"CASE WHEN t > 0 THEN {_sum(terms)} ELSE {zero} END"))


def rank_edge_flags(v: str) -> dict[str, Column]:
    """Rows that the rank path treats apart: nothing known, nothing finite, one value only."""
    known = f"filter({v}, x -> x IS NOT NULL AND NOT isnan(x))"
    finite = f"filter({known}, x -> abs(x) <> double('Infinity'))"
    return {
        "all_missing": F.expr(f"size({known}) = 0"),
        "all_infinite": F.expr(f"size({known}) > 0 AND size({finite}) = 0"),
        "is_constant": F.expr(f"size({finite}) = size({v}) AND size(array_distinct({v})) = 1"),
    }
