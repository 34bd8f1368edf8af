"""poolwright: nightly account-to-pool routing as Spark DataFrame jobs.

Sub-packages:
  sources    -- reading, conforming and writing tables; test fixtures
  functions  -- column expressions (classifiers, day math, best-row picks)
  operators  -- table-to-table jobs: features, tagging, fair share, apply, maintenance
  plans      -- the nightly pipeline and the reports built on it
"""

from poolwright.config import RunConfig

__all__ = ["RunConfig"]
