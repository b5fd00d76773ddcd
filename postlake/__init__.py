"""postlake: a PySpark library for cleaning and analysing social-post records.

Posts, geolocation and user records arrive as JSON topics, CSV files, JDBC
tables or record streams.  One set of DataFrame transforms cleans them for
both batch and Structured Streaming, and the analytics in
:mod:`postlake.plans.questions` answer the usual questions over the clean
tables.  Everything is declared with the DataFrame API so Catalyst plans it.
"""

__version__ = "0.1.0"
