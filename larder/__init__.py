"""larder: attribute affinity for retail tables, as PySpark DataFrame jobs."""
