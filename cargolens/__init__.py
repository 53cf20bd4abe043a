"""cargolens: marketplace logistics analytics on Spark.

Profiling, core item and order tables, the analytical mart, time-ordered
model experiments on MLlib, audit and scoring jobs and Structured Streaming
monitors, each written as DataFrame / SQL plans.
"""

__version__ = "0.1.0"
