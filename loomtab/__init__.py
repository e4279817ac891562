"""loomtab: curation of tabular exports and workflow analytics as Spark DataFrame jobs."""
