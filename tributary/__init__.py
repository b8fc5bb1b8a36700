"""tributary — clickstream and change-data analytics written as Spark jobs.

Every public function takes and returns DataFrames (or writes them); the
work runs in Spark's planner and executors, never on the driver.
"""

__version__ = "0.1.0"
