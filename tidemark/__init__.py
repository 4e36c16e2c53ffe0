"""tidemark: marketing and customer-lifecycle analytics as Spark jobs.

Every operator is a plain function from DataFrames (and an explicit ``as_of``
date) to a DataFrame; nothing reads the clock and nothing is collected.
"""
