"""Set-based auditing of bulk content conversion on Spark."""
