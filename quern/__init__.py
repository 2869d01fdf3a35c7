"""Spark-native record linkage and tabular data-processing engine.

Everything is expressed as DataFrame -> DataFrame or Column -> Column
functions; nothing in the core imports the optional ``quern.llm`` subpackage.
"""

__version__ = "0.1.0"
