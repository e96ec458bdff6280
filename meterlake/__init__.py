"""Smart-meter analytics on Spark: cleansing, peaks, tariffs, star schema, marts, reports and streams."""
