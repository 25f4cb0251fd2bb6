"""simloom: similarity search, de-duplication and clustering of vectors on Spark.

The package is a set of DataFrame -> DataFrame operators.  Plans are declared
with the DataFrame API; Arrow-batched Python is used only for vector kernels
and for graph work inside a partition.

    functions   column expressions (vectors, paths, names)
    sources     catalogs, line files, group text, ``.npy`` arrays
    sinks       split writers, label sets, reports
    operators   search, edges, components, removal, clusters, labels, ...
    plans       the two end-to-end pipelines built from the operators
    streaming   incremental versions
    llm         training-data operators (optional; nothing else imports it)
"""

__version__ = "0.1.0"
