"""Cloud-billing cost audit as PySpark DataFrame jobs."""
