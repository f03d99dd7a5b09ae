"""graphloom: document text to typed entity graphs, as Spark plans.

Sub-packages: ``sources`` (readers), ``functions`` (column expressions), ``operators`` (DataFrame
to DataFrame steps), ``plans`` (end-to-end queries), ``sinks`` (writers), ``streaming`` (incremental
runs) and ``llm`` (training-data operators, which nothing else here imports).
"""

__version__ = "0.1.0"
