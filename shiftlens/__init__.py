"""shiftlens: production-line analytics as PySpark DataFrame jobs.

Every metric is grouped by (line, shift) and computed for all lines and all shifts in one
distributed plan.  See README.md for the map of modules.
"""

from shiftlens.sources.site import Site

__all__ = ["Site"]
