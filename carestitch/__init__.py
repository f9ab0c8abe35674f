"""Clinical-data harmonisation as Spark jobs: source extracts in, common data model out."""
