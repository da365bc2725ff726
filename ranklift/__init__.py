"""ranklift: grouped binary-outcome analytics on Spark DataFrames.

Layout
------
- ``sources``   loading, schema checks, results log, persisted state
- ``functions`` column expressions (row-wise, stay inside codegen)
- ``operators`` DataFrame-in / DataFrame-out building blocks
- ``plans``     end-to-end compositions and the query catalog
- ``streaming`` the stateless operators run on a streaming frame
"""

__version__ = "0.1.0"
