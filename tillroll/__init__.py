"""tillroll: a Spark-native retail sales pipeline.

Stages (each a plain ``DataFrame -> DataFrame`` function):

    raw sales, raw customers  (sources.fixtures)
      -> cleaned sales        (plans.clean)
      -> enriched sales       (plans.enrich)
      -> daily / product / regional / customer metrics (plans.metrics)
      -> quality and summary figures (clean / enrich / metrics / quality)
      -> published catalog tables   (plans.publish, sources.warehouse)

Everything is expressed with DataFrame operations so Catalyst can prune,
push down and pick the physical strategy; no Python UDF is used.
"""

from tillroll.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
