"""playlens: playback telemetry and viewing quality on Apache Spark.

The library is a set of DataFrame-to-DataFrame functions.  Raw session reports become
quality-level rows, a quarantine of faulty rows and daily viewer scores; collector events
become session analytics; and a family of report functions reads those tables.
"""

__version__ = "0.1.0"
