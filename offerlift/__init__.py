"""Campaign-response analytics as Spark jobs.

``functions``  column expressions (hash-uniform numbers, timestamps, paths, JSON)
``sources``    tables, files, registry, artifacts and the test-table mappings
``operators``  DataFrame-to-DataFrame operators
``plans``      training, scoring and retraining jobs, plus the query catalogue
``streaming``  Structured Streaming jobs
"""
