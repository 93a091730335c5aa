"""Layered (raw -> clean -> published) analytics and a binary-outcome modelling
stage, expressed as Spark DataFrame operators.

Every operator is a plain function ``DataFrame -> DataFrame`` whose column names
are parameters; nothing leaves the cluster except scalars (counts, metrics).
"""

__version__ = "0.1.0"
