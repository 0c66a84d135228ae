"""Variant enrichment on Spark DataFrames.

Every operator takes and returns DataFrames, so they compose with ``df.transform``.  The layers are
``functions`` (Column to Column), ``operators`` (DataFrame to DataFrame), ``sources`` and ``sinks``
(text and Parquet), and ``plans`` (whole annotation pipelines).
"""

from lociweave.model import VARIANT_KEY, contig_rank
from lociweave.session import recommended_conf

__all__ = ["VARIANT_KEY", "contig_rank", "recommended_conf"]
