"""paywatch: payment-transaction risk analytics written as Spark DataFrame, ML and streaming jobs."""
