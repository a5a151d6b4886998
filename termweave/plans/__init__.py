"""The import products, one function per product."""
