"""Report compositions, the driver-table city model and the query registry."""
