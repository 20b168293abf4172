"""opsmart: operational analytics on Spark DataFrames.

``functions``  Column expressions (bands, flags, scores, ratios, calendar parts)
``operators``  DataFrame -> DataFrame operators (joins, rollups, ordered, reshape, graph, quality)
``sources``    readers for landed files and writers for finished tables
``plans``      staging models, marts, summaries and dashboard measures built from the above
"""
