"""Operations of a training-data pipeline, as Spark jobs.

One module per operation; nothing outside this subpackage imports it.
"""
