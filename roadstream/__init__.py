"""roadstream: roadside-checkpoint analytics as PySpark DataFrame operators."""
