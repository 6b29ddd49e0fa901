"""specloom: a PySpark-native engine for device-catalog data."""
