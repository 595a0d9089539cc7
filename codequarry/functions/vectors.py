"""Vector columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from codequarry.functions.text import col

# Added to the product of norms, and the score of what cannot be scored.
NORM_GUARD = 1e-9
NO_SCORE = -1.0
# Scores are ranked at this many decimals: copies of a vector then tie in
# whatever batch they are scored, and the id decides.
SCORE_DECIMALS = 9


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(
        col(a), col(b), lambda x, y: x.cast("double") * y.cast("double")
    )
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def cosine(
    a: Column | str, b: Column | str,
    norm_a: Column | None = None, norm_b: Column | None = None,
) -> Column:
    """Guarded cosine; -1 where a vector is missing, NaN or of another width."""
    norm_a = norm(a) if norm_a is None else norm_a
    norm_b = norm(b) if norm_b is None else norm_b
    raw = dot(a, b) / (norm_a * norm_b + F.lit(NORM_GUARD))
    usable = F.size(col(a)) == F.size(col(b))
    score = F.when(usable & ~F.isnan(raw), raw)
    return F.round(F.coalesce(score, F.lit(NO_SCORE)), SCORE_DECIMALS)
