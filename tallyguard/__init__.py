"""tallyguard: a PySpark-native engine for payment-transaction risk analytics."""
