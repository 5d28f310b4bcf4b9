"""docweave — document localization data work as Spark DataFrame jobs.

Every public function takes and returns DataFrames (usable with ``.transform``)
or builds a Column expression; the heavy lifting stays inside Catalyst.
"""

from docweave.session import get_spark, checkpoint_dir, read_table

__all__ = ["get_spark", "checkpoint_dir", "read_table"]
