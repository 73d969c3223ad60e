"""forgeline: a Spark-native feature engine for industrial sensor exports.

Raw delimited sensor files go through three layers, each expressed as
DataFrame transformations that Catalyst plans and Spark executes:

* Bronze  - every raw row as strings, with provenance and accept/reject codes
* Silver  - normalised machine codes, timestamps and units, rule-based
            dedup, benchmarked imputation
* Gold    - one row per machine and hour with rolling features, incident
            lookbacks, multi-horizon failure labels and a temporal split

Sub-packages:
    functions  Column -> Column expressions (parsing, cleaning, arithmetic)
    sources    readers, fixture views over the driver tables, sinks
    operators  DataFrame -> DataFrame operators (dedup, units, features, ...)
    plans      end-to-end plans (pipeline runner, registered queries)
    streaming  incremental Bronze ingestion with Structured Streaming
"""

__version__ = "0.1.0"
