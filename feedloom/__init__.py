"""Content feeds as Spark jobs: normalise, gate, enrich, de-duplicate, rank and publish."""
