"""lumenrec: a PySpark-native course-recommendation feature engine.

Every operator is a ``DataFrame -> DataFrame`` function over Spark built-ins.
Dates, the city and the "today" stamp are parameters; nothing is collected
to the driver and no Python UDF is registered.
"""

__version__ = "0.1.0"
