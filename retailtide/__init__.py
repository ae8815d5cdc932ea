"""Retail reporting on Spark: order windows, behaviour-log metrics, change-record flattening."""
