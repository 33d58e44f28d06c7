"""Reading and writing: request windows, event collection, tables."""
