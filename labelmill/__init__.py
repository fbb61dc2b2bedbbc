"""Text-dataset curation on Spark DataFrames."""
