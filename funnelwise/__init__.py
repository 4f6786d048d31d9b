"""CRM pipeline analytics as PySpark DataFrame operators."""
