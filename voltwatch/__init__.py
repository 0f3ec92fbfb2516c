"""voltwatch: rare-event sensor analytics as Spark DataFrame operators.

Every public function takes and returns DataFrames; column names come from
a :class:`~voltwatch.config.Columns` value instead of being hard-wired.
"""

from voltwatch.config import Columns, Scale

__all__ = ["Columns", "Scale"]
