"""Normal distribution function and quantile as SQL text.

The text is valid in Spark SQL, so it stays in the JVM, and it can be nested in lambdas.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of Hart's double-precision normal distribution function.
HART_TOP = (
    0.0352624965998911,
    0.700383064443688,
    6.37396220353165,
    33.912866078383,
    112.079291497871,
    221.213596169931,
    220.206867912376,
)
HART_BOTTOM = (
    0.0883883476483184,
    1.75566716318264,
    16.064177579207,
    86.7807322029461,
    296.564248779674,
    637.333633378831,
    793.826512519948,
    440.413735824752,
)

# Coefficients of algorithm AS 241 (normal quantile), lowest power first.
AS241_A = (
    3.3871328727963666080,
    133.14166789178437745,
    1971.5909503065514427,
    13731.693765509461125,
    45921.953931549871457,
    67265.770927008700853,
    33430.575583588128105,
    2509.0809287301226727,
)
AS241_B = (
    1.0,
    42.313330701600911252,
    687.18700749205790830,
    5394.1960214247511077,
    21213.794301586595867,
    39307.895800092710610,
    28729.085735721942674,
    5226.4952788528545610,
)
AS241_C = (
    1.42343711074968357734,
    4.63033784615654529590,
    5.76949722146069140550,
    3.64784832476320460504,
    1.27045825245236838258,
    0.241780725177450611770,
    0.0227238449892691845833,
    0.000774545014278341407640,
)
AS241_D = (
    1.0,
    2.05319162663775882187,
    1.67638483018380384940,
    0.689767334985100004550,
    0.148103976427480074590,
    0.0151986665636164571966,
    0.000547593808499534494600,
    1.05075007164441684324e-9,
)
AS241_E = (
    6.65790464350110377720,
    5.46378491116411436990,
    1.78482653991729133580,
    0.296560571828504891230,
    0.0265321895265761230930,
    0.00124266094738807843860,
    0.0000271155556874348757815,
    2.01033439929228813265e-7,
)
AS241_F = (
    1.0,
    0.599832206555887937690,
    0.136929880922735805310,
    0.0148753612908506148525,
    0.000786869131145613259100,
    0.0000184631831751005468180,
    1.42151175831644588870e-7,
    2.04426310338993978564e-15,
)


def number(value: float) -> str:
    """Double literal readable by Spark SQL."""
    return f"CAST({float(value)!r} AS DOUBLE)"


def _poly(coefficients, x: str) -> str:
    """Horner form, highest power first."""
    text = number(coefficients[0])
    for c in coefficients[1:]:
        text = f"({text}*{x}+{number(c)})"
    return text


def normal_cdf_sql(x: str) -> str:
    a = f"abs({x})"
    e = f"exp(-{a}*{a}/2)"
    near = f"{e}*{_poly(HART_TOP, a)}/{_poly(HART_BOTTOM, a)}"
    far = f"{e}/({a}+1/({a}+2/({a}+3/({a}+4/({a}+{number(0.65)})))))/{number(2.506628274631)}"
    tail = (
        f"(CASE WHEN {a} > 37 THEN {number(0)} "
        f"WHEN {a} < {number(7.07106781186547)} THEN {near} ELSE {far} END)"
    )
    return f"(CASE WHEN {x} > 0 THEN 1 - {tail} ELSE {tail} END)"


def normal_quantile_sql(p: str) -> str:
    def ratio(top, bottom, r):
        return f"({_poly(tuple(reversed(top)), r)}/{_poly(tuple(reversed(bottom)), r)})"

    q = f"({p}-{number(0.5)})"
    centre = f"({number(0.180625)}-{q}*{q})"
    tail = f"sqrt(-ln(least({p},1-{p})))"
    mid = f"({tail}-{number(1.6)})"
    deep = f"({tail}-{number(5.0)})"
    sign = f"(CASE WHEN {q} < 0 THEN -1 ELSE 1 END)"
    return (
        f"(CASE WHEN {p} IS NULL OR {p} <= 0 OR {p} >= 1 THEN CAST(NULL AS DOUBLE) "
        f"WHEN abs({q}) <= {number(0.425)} THEN {q}*{ratio(AS241_A, AS241_B, centre)} "
        f"WHEN {tail} <= 5 THEN {sign}*{ratio(AS241_C, AS241_D, mid)} "
        f"ELSE {sign}*{ratio(AS241_E, AS241_F, deep)} END)"
    )


def normal_cdf(column: str) -> Column:
    return F.expr(normal_cdf_sql(column))


def normal_quantile(column: str) -> Column:
    return F.expr(normal_quantile_sql(column))


def two_sided_p(z: str) -> Column:
    """2·(1 − Φ(|z|)) taken from the lower tail, where no digits are lost."""
    return F.expr(f"2*{normal_cdf_sql(f'(-abs({z}))')}")
