"""Flight analytics on Spark: batch history, tracking events, BI summaries.

Every step is a function from DataFrame to DataFrame; only ``sources``,
``streaming`` and ``plans`` touch storage.
"""

from skyledger.config import LakeConfig, Rules

__all__ = ["LakeConfig", "Rules"]
