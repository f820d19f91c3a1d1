"""Reading and writing: the JSON landing zone, Parquet tables, scratch folders."""
