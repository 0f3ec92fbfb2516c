"""Tail probabilities as column expressions (D2, D4): folds over short sequences, no UDF."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Terms of the Kolmogorov series; each form is used where a few suffice.
KS_TERMS = 20
#: Below this many lattice points (n * m) the two-sample distribution is counted exactly.
EXACT_CELLS = 10_000


def kolmogorov_tail(lam: Column) -> Column:
    """P(K > lam) of the Kolmogorov distribution.

    Below 1.18 the theta form converges at once (and gives 1 at 0), above it
    the alternating series does.
    """
    js = F.sequence(F.lit(1), F.lit(KS_TERMS))
    theta = F.aggregate(js, F.lit(0.0), lambda acc, j: acc + F.exp(-F.pow(2.0 * j - 1.0, F.lit(2.0)) * (math.pi**2 / 8) / (lam * lam)))
    series = F.aggregate(js, F.lit(0.0), lambda acc, j: acc + F.when(j % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * j * j * lam * lam))
    p = F.when(lam <= 0, 1.0).when(lam < 1.18, 1.0 - math.sqrt(2 * math.pi) / lam * theta).otherwise(series)
    return F.when(lam.isNotNull(), F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))


def ks_exact(d: Column, n: Column, m: Column) -> Column:
    """P(D >= d) of two continuous samples of n and m values.

    u[i, j] is the share of lattice paths to (i, j) whose gap |i/n - j/m| never
    reached d: u[i, j] = i/(i+j) u[i-1, j] + j/(i+j) u[i, j-1] inside the band
    and 0 outside.  The outer fold runs over the larger sample, its state is
    one row of the smaller.
    """
    big, small = F.greatest(n, m).cast("int"), F.least(n, m).cast("int")
    inside = lambda i, j: F.abs(i / big - j / small) < d - 1e-12
    steps = F.sequence(F.lit(1), small)

    def row(above: Column, i: Column) -> Column:
        """u[i, 0..small] from u[i-1, 0..small] (for i = 0 only the left neighbour counts)."""

        def cell(acc: Column, j: Column) -> Column:
            u = F.get(above, j) * i / (i + j) + F.element_at(acc, -1) * j / (i + j)
            return F.concat(acc, F.array(F.when(inside(i, j), u).otherwise(0.0)))

        return F.aggregate(steps, F.array(F.when(inside(i, F.lit(0)), F.get(above, F.lit(0))).otherwise(0.0)), cell)

    # row 0: 1 at the start, and no row above it
    zero = F.transform(F.sequence(F.lit(0), small), lambda j: F.when(j == 0, 1.0).otherwise(0.0))
    first = row(zero, F.lit(0.0))
    last = F.aggregate(F.sequence(F.lit(1), big), first, lambda acc, i: row(acc, i.cast("double")))
    return F.when(d <= 0, 1.0).otherwise(F.greatest(F.lit(0.0), 1.0 - F.element_at(last, -1)))


def ks_tail(d: Column, n: Column, m: Column) -> Column:
    """Two-sample KS p-value: exact for small samples, else asymptotic with
    Stephens' correction; NULL where a side has no values."""
    size = F.nullif(n.cast("double") * m.cast("double"), F.lit(0.0))
    ne = size / (n + m)
    lam = (F.sqrt(ne) + 0.12 + 0.11 / F.sqrt(ne)) * d
    # the branch is also the fold's bound: sequences stay short where the other form is used
    few = F.coalesce(size <= EXACT_CELLS, F.lit(False)) & d.isNotNull()
    k, l = F.when(few, n).otherwise(1), F.when(few, m).otherwise(1)  # noqa: E741
    return F.when(few, ks_exact(d, k, l)).otherwise(kolmogorov_tail(lam))


def log_gamma(x: Column) -> Column:
    """ln Gamma(x) for x > 0: Stirling's series ten steps up, less the logs of the steps."""
    y = x + 10.0
    up = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, F.lit(5.0)))
    return up - F.aggregate(F.sequence(F.lit(0), F.lit(9)), F.lit(0.0), lambda acc, k: acc + F.log(x + k))


def gamma_tail(s: Column, z: Column) -> Column:
    """Regularised upper incomplete gamma function Q(s, z).

    Below s + 1 the power series of P, folded with its running term; above it
    the continued fraction of Q, folded by the modified Lentz recurrence.  The
    terms grow with the square root of s, as the series needs.
    """
    terms = F.sequence(F.lit(1), (200 + 10 * F.sqrt(s)).cast("int"))
    scale = F.exp(s * F.log(z) - z - log_gamma(s))

    def add(acc: Column, k: Column) -> Column:
        term = acc["term"] * z / (s + k)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    start = F.struct((1.0 / s).alias("term"), (1.0 / s).alias("total"))
    lower = F.aggregate(terms, start, add, lambda acc: acc["total"]) * scale

    def away(x: Column) -> Column:
        return F.when(F.abs(x) < 1e-300, 1e-300).otherwise(x)

    def step(acc: Column, k: Column) -> Column:
        an, b = -k * (k - s), z + 1.0 - s + 2.0 * k
        d = 1.0 / away(an * acc["d"] + b)
        c = away(b + an / acc["c"])
        return F.struct(c.alias("c"), d.alias("d"), (acc["h"] * d * c).alias("h"))

    first = 1.0 / away(z + 1.0 - s)
    upper = F.aggregate(terms, F.struct(F.lit(1e300).alias("c"), first.alias("d"), first.alias("h")), step, lambda acc: acc["h"]) * scale
    q = F.when(z <= 0, 1.0).when(z < s + 1.0, 1.0 - lower).otherwise(upper)
    return F.least(F.greatest(q, F.lit(0.0)), F.lit(1.0))


def chi2_tail(x: Column, dof: Column) -> Column:
    """Upper tail of the chi-square distribution; NULL without degrees of freedom."""
    s = F.when(dof > 0, dof / 2.0)
    return F.when(s.isNotNull(), gamma_tail(F.coalesce(s, F.lit(0.5)), x.cast("double") / 2.0))
