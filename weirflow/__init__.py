"""weirflow: sensor-telemetry analytics as plain Spark DataFrame jobs.

The same column expressions and DataFrame transforms serve batch queries and
Structured Streaming; nothing in the hot path leaves the JVM.
"""

__version__ = "0.1.0"
