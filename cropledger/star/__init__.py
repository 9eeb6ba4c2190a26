"""Star-schema tables (orders, line items, customers, parts) read as scenario results."""
