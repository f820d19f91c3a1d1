"""Click analytics on Spark: raw events to visits and business tables, batch and stream."""
