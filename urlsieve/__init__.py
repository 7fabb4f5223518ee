"""urlsieve: offline screening of web addresses on Spark.

``functions``  column expressions over one address
``sources``    readers, writers and model folders
``operators``  table-to-table operators (joins, aggregates, splits, metrics, clustering)
``plans``      the end-to-end flows built from them
"""
