"""Spark-native analytics for a metadata-driven data platform.

Sub-packages
------------
``functions``  Column expressions shared by the operators
``sources``    readers and writers (templates, files, tables, JDBC)
``operators``  ``DataFrame -> DataFrame`` operators
``streaming``  Structured Streaming forms of the polling jobs
``plans``      the registered queries, their test corpus and SQL oracles
"""
