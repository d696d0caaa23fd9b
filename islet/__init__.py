"""islet — session-log analytics as Spark DataFrame plans.

Every operator is a plain function ``DataFrame -> DataFrame`` whose column
names are parameters, so the same code runs on the work-session log schema
and on any other table with the same shape.
"""

__version__ = "0.1.0"
