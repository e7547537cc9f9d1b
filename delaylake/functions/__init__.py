"""Column helpers: parsing, time arithmetic, nested paths and hash sampling."""
