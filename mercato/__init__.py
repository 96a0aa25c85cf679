"""mercato — retail analytics on Spark.

Gold tables, business measures, forecasting, segmentation, a catalogue of
business questions and streaming alert jobs, all expressed as DataFrame /
Spark SQL plans so Catalyst and AQE pick the physical strategy.
"""

__version__ = "0.1.0"
