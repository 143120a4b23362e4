"""The size bound of lookup sides that we broadcast on our own say."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Bytes of terms, with 16 more for each row's number and overhead.
MAX_BROADCAST_BYTES = 64 << 20


def head_that_fits(vocab: DataFrame, rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> int:
    """How many of the first rows of a numbered vocabulary may be broadcast:
    ``rows``, or a half, a quarter, ... of them, the first whose measured bytes
    stay within ``max_bytes``. One aggregate over the vocabulary."""
    sizes = [rows >> i for i in range(rows.bit_length())]
    if not sizes:
        return 0
    weight = F.octet_length("term") + F.lit(16)
    sums = vocab.agg(*[F.sum(F.when(F.col("term_idx") < F.lit(n), weight)).alias(str(n))
                       for n in sizes]).first()
    return next((n for n in sizes if (sums[str(n)] or 0) <= max_bytes), 0)
