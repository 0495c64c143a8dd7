"""Windowed sensor analytics as Spark DataFrame jobs.

Readings go through parse -> window -> fuse -> split -> fit -> evaluate, and every
step is a function from DataFrame to DataFrame.  Nothing here opens a session.
"""
