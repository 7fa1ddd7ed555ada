"""Visit tables derived from the sample tables, the queries over them, and the SQL to check them."""
