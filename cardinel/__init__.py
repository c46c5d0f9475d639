"""Card transaction monitoring on Spark.

Every operator is a function from DataFrame to DataFrame that accepts batch
and streaming inputs alike; `plans.monitor` strings them together.
"""
