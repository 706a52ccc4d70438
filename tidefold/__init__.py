"""tidefold: change data capture over delimited clinical messages, as Spark jobs."""
