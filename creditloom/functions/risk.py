"""Expected loss and risk bands (K1, K2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_LGD = 0.45

# Band names with their exclusive upper bounds.
BANDS = (("Low", 0.10), ("Medium", 0.20), ("High", 0.35), ("Very High", None))
BAND_ORDER = tuple(name for name, _ in BANDS)


def expected_loss(pd: Column, ead: Column | None = None, lgd: float = DEFAULT_LGD) -> Column:
    loss = pd * F.lit(float(lgd))
    return loss if ead is None else loss * ead


def risk_band(pd: Column) -> Column:
    """Band of a probability; missing or NaN is 'Unknown' (NaN sorts highest in Spark)."""
    out = F.when(pd.isNull() | F.isnan(pd), F.lit("Unknown"))
    for name, bound in BANDS:
        if bound is not None:
            out = out.when(pd < F.lit(bound), F.lit(name))
    return out.otherwise(F.lit(BANDS[-1][0]))
