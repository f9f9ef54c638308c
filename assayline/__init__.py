"""Layered laboratory-measurement analytics on Spark.

functions  column in, column out
operators  DataFrame in, DataFrame out, column names as parameters
sources    landed documents, layer tables, staging
plans      bronze, silver, gold, quality, serving, reports, jobs
"""
