"""Inputs and outputs: table access and stand-in inputs (tables), sinks
(overwrite, partitioned, append, CSV, catalog) and JSON flattening."""
