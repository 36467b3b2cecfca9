"""Fleet-scale analysis of Spark job telemetry, written as DataFrame operators."""
