"""paperflow: paper-feed analytics as plain Spark DataFrame operators.

Every operator takes and returns DataFrames or Columns; nothing here collects
rows to the driver.  See README.md for the map of the package.
"""
