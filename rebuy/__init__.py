"""rebuy — repeat-purchase analytics as Spark DataFrame operators.

Every operator is a plain function from DataFrames (and parameters) to a
DataFrame; nothing row-level is pulled to the driver except fitted
constants (means, medians, vocabularies) and models.
"""

__version__ = "0.1.0"
