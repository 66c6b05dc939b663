"""lakestar — a Spark-native medallion build (raw -> silver -> gold star schema).

Everything is expressed as DataFrame plans: Catalyst does pushdown and pruning,
shuffles happen only on join / dedupe keys, and no Python UDF sits on a data path.
"""

__version__ = "0.1.0"
