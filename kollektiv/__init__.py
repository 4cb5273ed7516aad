"""kollektiv — a Spark-native medallion pipeline for public-transport feeds.

NeTEx network archives and SIRI timetable snapshots are extracted as parallel
Spark jobs, landed in day-partitioned bronze tables, gated by data-quality
checks, cleaned into silver views and published as a gold star schema.
"""

__version__ = "0.1.0"
