"""Marketplace order analytics as Spark DataFrame plans.

* ``functions``  column expressions and aggregate expressions
* ``sources``    declared schemas, scans, sinks
* ``operators``  reusable DataFrame -> DataFrame operators (running sums, ranks, checks, drift)
* ``plans``      the datasets and jobs built from them
"""
