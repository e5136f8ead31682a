"""The driver's tables bound to the library's roles, and the queries over them."""
