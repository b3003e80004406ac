"""cartograph: behaviour-log analytics expressed as Spark DataFrame plans.

Layers
------
functions/  column expressions (no actions, no sessions)
sources/    readers for raw text, typed logs, exported text, and the table bindings
operators/  DataFrame -> DataFrame transformations (cleaning, features, index,
            co-occurrence, k-means, PersonalRank)
sinks/      text / parquet writers in the exported line formats
plans/      end-to-end batch jobs and the registered query catalogue
streaming/  Structured Streaming variants of the log cleaning and user aggregates
"""

__version__ = "0.1.0"
