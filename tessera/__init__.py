"""tessera: Spark-native jobs for line-oriented text and translation corpora.

Sub-packages: ``sources`` (scans and sinks), ``functions`` (column
expressions, normalisation, text processors), ``operators`` (wrap/unwrap,
decoder-output parsing, prefix sums, placeholders, scoring, routing,
truecasing, BPE, jobs), ``streaming`` (Structured Streaming jobs) and
``plans`` (registered queries with their DuckDB oracle SQL).
"""

__version__ = "0.1.0"
