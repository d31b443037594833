"""contrail: Spark-native flight-state analytics.

Every transform is a plain DataFrame -> DataFrame function that works on
batch and streaming input alike; only ``contrail.streaming`` knows about
``writeStream``.
"""

__version__ = "0.1.0"
