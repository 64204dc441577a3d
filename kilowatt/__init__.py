"""kilowatt — renewable-energy analytics as plain Spark DataFrame jobs.

Every operator is a lazy DataFrame-in / DataFrame-out function; only the
functions in :mod:`kilowatt.sinks` and :mod:`kilowatt.streaming` act.
"""

__version__ = "0.1.0"
