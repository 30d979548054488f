"""Model monitoring as lazy Spark DataFrame jobs.

``sources``    configured source tables, configuration tables, sinks
``functions``  column expressions and exact order statistics
``operators``  calendar, bins, the 27 metrics, result roll-ups, dashboard queries
``plans``      whole jobs: monitoring run, training run, backfill
"""
