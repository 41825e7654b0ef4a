"""tillroll — retail purchase analytics on Spark.

Snowflake staging (dims + fact), fifteen sales marts, dashboard reports and
the write-side data rules, all as DataFrame / Spark SQL / Structured
Streaming jobs. Every operator maps a DataFrame to a DataFrame; nothing is
collected to the driver.
"""

__all__ = ["session", "schemas"]
