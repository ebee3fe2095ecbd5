"""Order-event analytics on PySpark: live window metrics, daily totals, odd hours."""
