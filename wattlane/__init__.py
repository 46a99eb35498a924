"""wattlane: Spark-native panel time-series forecasting and anomaly scoring.

Every operator takes DataFrames and returns DataFrames (or small fitted
parameter objects).  Heavy lifting is expressed with built-in Spark SQL
expressions so Catalyst can prune, push down and code-generate it.
"""

from wattlane.errors import DataValidationError
from wattlane.session import get_spark

__all__ = ["DataValidationError", "get_spark"]
__version__ = "0.1.0"
