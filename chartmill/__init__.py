"""Spark-native cleaning, profiling and risk modelling of tabular records.

``functions``  expressions on columns, no data access
``operators``  DataFrame -> DataFrame steps
``sources``    reading and writing tables, metrics and models
``plans``      whole workloads composed from the operators
"""
