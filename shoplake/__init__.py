"""Shop-event analytics as PySpark DataFrame operators.

Layers: ``sources`` read and encode events, ``operators`` are pure
``DataFrame -> DataFrame`` steps, ``sinks`` write and maintain tables,
``plans`` chain the steps into jobs and reports, ``streaming`` runs the same
steps incrementally, and ``registry`` binds everything to the test tables.
"""
