"""vintagelake: forecast vintages as lazy PySpark DataFrame plans.

A forecast vintage row says: report R, issued on date D, predicted value V for
month M at location L.  Every function here takes and returns DataFrames in long
form; wide tables are a presentation view built last.
"""

from vintagelake.session import ensure_checkpoint_dir, get_spark

__all__ = ["get_spark", "ensure_checkpoint_dir"]
