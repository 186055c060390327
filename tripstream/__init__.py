"""tripstream: trip-event analytics as Spark DataFrame plans.

Every transform is a DataFrame -> DataFrame function that runs unchanged on a
batch DataFrame and on a streaming one, except where Spark only offers the
operation in one mode (deduplication within a watermark is stream-only,
analytic range frames are batch-only).
"""

from tripstream.config import Params, DEFAULT_PARAMS

__all__ = ["Params", "DEFAULT_PARAMS"]
