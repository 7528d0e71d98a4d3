"""Trip-like event files to a trustworthy star schema, as Spark jobs."""
