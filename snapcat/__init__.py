"""snapcat: snapshot-catalog analytics as PySpark DataFrame operators.

A catalog (creators -> releases -> items) is observed again and again; every
observation is a *snapshot*.  The package turns raw snapshot files into typed,
cleaned and gated tables, a star schema with a periodic-snapshot fact, marts and
analytical queries.  Every operator is a function from DataFrames to a DataFrame
(or from Columns to a Column), so Catalyst sees the whole plan.
"""
