"""dimforge: staging-to-dimension loading operators on Spark DataFrames.

Every operator takes and returns DataFrames and runs no action unless its
docstring says it is a guard.  A load is computed as the next table state
and checked before a writer publishes it.
"""

from dimforge.context import RunContext

__all__ = ["RunContext"]
