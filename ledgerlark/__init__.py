"""Order, invoice and stock analytics as Spark DataFrame jobs."""
