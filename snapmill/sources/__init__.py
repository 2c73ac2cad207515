"""Raw CSV sources and the layered Parquet lake."""
