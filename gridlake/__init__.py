"""gridlake: power-market analytics written as plain Spark jobs.

Everything in the package takes and returns Spark ``DataFrame`` objects.  Nothing is executed until a
sink in :mod:`gridlake.sinks` writes, apart from the few places whose docstring says so.
"""

__version__ = "0.1.0"
