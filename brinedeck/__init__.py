"""Ocean-observation analytics as PySpark DataFrame operators."""
