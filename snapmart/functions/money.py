from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents_to_usd(cents) -> Column:
    """Integer cents → ``decimal(38,6)`` dollars (``number / 100.0``)."""
    c = F.col(cents) if isinstance(cents, str) else cents
    return (c.cast("decimal(38,0)") / F.lit(100.0).cast("decimal(4,1)")).cast("decimal(38,6)")
