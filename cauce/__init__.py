"""Cauce: a retail bank's medallion pipeline expressed as Spark DataFrame plans."""
