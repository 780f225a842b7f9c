"""Trip-quality and late-rate analytics as Spark DataFrame jobs.

Every operator is a function from DataFrames and parameters to a DataFrame.  Nothing here runs an
action unless its docstring says so, so callers decide when (and where) work is materialised.
"""

from tallygate.rules import DEFAULT_RULES, Rule, Severity
from tallygate.settings import Settings

__all__ = ["DEFAULT_RULES", "Rule", "Settings", "Severity"]
__version__ = "0.1.0"
