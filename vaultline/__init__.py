"""vaultline: a Spark-native bronze -> silver -> gold banking pipeline.

Every operator is a plain ``DataFrame -> DataFrame`` function meant for
``df.transform(...)``; nothing here starts an action unless its name says so
(``write_*``, ``publish*``, ``ingest``, ``run_*``).
"""

__all__ = ["config", "session"]
