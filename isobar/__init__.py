"""isobar: gridded forecast analytics on Spark DataFrames.

Fields are long tables ``(run, param, [member], step, iy, ix, value)`` on a
regular 0.125 degree latitude/longitude grid.  Every operator is a function
``DataFrame -> DataFrame`` built from Spark SQL expressions; pandas code runs
only inside Spark tasks where no built-in operator can express the work.
"""

__version__ = "0.1.0"
