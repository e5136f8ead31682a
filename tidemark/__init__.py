"""Tool-adoption analytics as plain PySpark jobs.

Package downloads and forum posts come in; audited daily counts, mentions of
tracked projects with a sentiment score, and trailing-window rollups go out.
Every operator takes and returns a DataFrame and runs on the executors.
"""
