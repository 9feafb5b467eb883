"""Training-data pipeline operators. Nothing else in the package imports this one."""
