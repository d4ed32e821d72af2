"""riverbed — change-data replication on Spark DataFrames and Structured Streaming.

Every operator takes DataFrames and returns DataFrames; nothing is collected to the
driver except small configuration frames whose size is checked first.
"""

__version__ = "0.1.0"
