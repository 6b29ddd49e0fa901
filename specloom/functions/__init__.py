"""specloom subpackage."""
