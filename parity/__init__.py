"""The engine over the driver's tables: registered queries, and the SQL each must agree with."""
