"""corvane: from event feeds to labelled article-by-equipment tables, as Spark DataFrame jobs."""
