"""Weekly player analytics on Spark: report tables built from reusable DataFrame operators."""
