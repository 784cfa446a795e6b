"""parcelgrid: property-intelligence jobs on Spark.

Feed loads, keyed merges, blocked record linkage, analytical queries and
signals, all expressed as DataFrame / SQL plans.  Every public job takes
DataFrames (or a session plus a data folder) and returns a lazy DataFrame.
"""

__version__ = "0.1.0"
