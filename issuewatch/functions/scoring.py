"""M1-M6: numeric column functions. All native Catalyst expressions (codegen), no UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values from the reference workload (must match for equal results).
SIMILARITY_SCALE = 50.0  # exp(-distance / 50)
DTW_RADIUS = 1


def issue_score(viewed, liked, num_of_comments) -> Column:
    """Viewed + ln(1 + liked) + ln(1 + num_of_comments)."""
    v, l, c = (F.col(x) if isinstance(x, str) else x for x in (viewed, liked, num_of_comments))
    return v.cast("double") + F.log1p(l.cast("double")) + F.log1p(c.cast("double"))


def log_frequency(total) -> Column:
    """A2: ln(sum + 1)."""
    t = F.col(total) if isinstance(total, str) else total
    return F.log1p(t.cast("double"))


def alert_value(similarity, frequency) -> Column:
    """M4: similarity_degree * total_frequency."""
    s = F.col(similarity) if isinstance(similarity, str) else similarity
    f = F.col(frequency) if isinstance(frequency, str) else frequency
    return s * f


def negativity(p_clean: Column) -> Column:
    """M6: 1 - P(clean)."""
    return F.lit(1.0) - p_clean


def dot_fixed(a: Column, b: Column, dim: int) -> Column:
    """Inner product of two arrays of known length `dim`, unrolled into plain element
    products so it compiles with whole-stage codegen (array HOFs are interpreted).
    Summation order is left to right, the same as `dot`."""
    acc = a[0].cast("double") * b[0].cast("double")
    for i in range(1, dim):
        acc = acc + a[i].cast("double") * b[i].cast("double")
    return acc


def norm_fixed(a: Column, dim: int) -> Column:
    return F.sqrt(dot_fixed(a, a, dim))
