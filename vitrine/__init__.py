"""vitrine: a PySpark-native analytics engine for a digital game storefront."""
