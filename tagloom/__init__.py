"""tagloom: DNA-encoded-library selection analytics as Spark jobs."""
