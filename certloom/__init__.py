"""certloom: inspection-certificate extraction as Spark DataFrame plans.

Layers
  functions/  pure ``Column -> Column`` scalars (capacity, IDs, dates, labels, text)
  operators/  DataFrame -> DataFrame building blocks (dictionary joins, grids,
              ID expansion, last-wins reduction, routing)
  sources/    readers and sinks (page grids, cells, dictionary, binary files,
              item / page-error / status tables)
  plans/      layout extractors and the end-to-end certificate pipeline
  streaming/  Structured Streaming ingest over newly arrived files
"""

__version__ = "0.1.0"
