"""noticelake: evidence-preserving public-auction notice data as PySpark DataFrames.

Sub-packages
------------
functions   Column -> Column building blocks (text, dates, classification, redaction)
sources     landed pages, feeds, lists, manifests and seed dimensions -> DataFrames
operators   DataFrame -> DataFrame relational operators (listing, upsert, evidence, ...)
plans       multi-step jobs (notice normalizers, publishing, reprocessing)
streaming   the same operators over Structured Streaming sources
"""

PARSER_VERSION = "1.4.0"


def _ship() -> None:
    """Send the package's functions with each job, so that executors need no installed copy of it."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship()
