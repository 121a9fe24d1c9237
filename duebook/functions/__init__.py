"""Column expressions. Each function takes and returns ``Column``; none needs a UDF."""
