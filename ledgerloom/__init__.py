"""Multi-tenant finance and workforce analytics as PySpark DataFrame functions."""
