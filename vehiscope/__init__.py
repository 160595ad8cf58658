"""vehiscope: Spark-native vehicle, complaint and fuel-station analytics.

Lazy DataFrame -> DataFrame jobs: clean three sources, join them into three
analysis tables, and ask analytical and data-quality questions of them.
"""

__version__ = "0.1.0"
