"""gridlark: tabular analytics and regression on Spark DataFrames.

Every operator is a function ``DataFrame -> DataFrame``; plans are lazy unless a
function is documented to fit something (then one bounded row set is read back).
"""

__version__ = "0.1.0"
