"""braidflow: batch dataflow programs (sources, row operations, groupings, joins, sinks) expressed as Spark DataFrames."""

__version__ = "0.1.0"
