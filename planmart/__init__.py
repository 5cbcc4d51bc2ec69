"""planmart — Spark-native revenue and opportunity planning marts.

Layers: ``sources`` (typed readers, adapters, publishing), ``functions``
(business-rule column builders), ``operators`` (fiscal calendar, joins),
``plans`` (pipelines and marts), ``streaming`` (weekly snapshot feed).
"""

from planmart.options import PlanOptions

__all__ = ["PlanOptions"]
