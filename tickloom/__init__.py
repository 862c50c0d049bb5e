"""tickloom: market-data, factor and corpus operators as Spark DataFrame programs."""
