"""tablefit: turn loosely matching match-result tables into model-ready
features and compare models on them, with every data step a Spark job.

Layout
------
- ``sources``    season paths, per-file-header CSV scans, table sinks/scans
- ``functions``  column expressions: typed cells, label expressions, vectors
- ``operators``  DataFrame -> DataFrame steps: exclusion, alignment, checks,
                 components, split, metrics, trainers
- ``plans``      whole runs: collation, model sweep, driver queries
- ``streaming``  incremental collation of newly arriving season files
"""

from tablefit.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
