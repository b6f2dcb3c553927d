"""Card-transaction risk analytics written with the Spark DataFrame, SQL, ML and streaming APIs."""
