"""Join helpers.

No join is hinted: Spark broadcasts a side by its size in bytes
(``spark.sql.autoBroadcastJoinThreshold``, from scan statistics or, with
AQE, from the measured shuffle output) and shuffles both sides beyond it.
(Except where rows are meant to be dealt by key: ``Shop.orderitem_by_product``.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tenant_dim(tenants: DataFrame, *cols: str) -> DataFrame:
    """(tenant_id, tenant_<col>...) projection of the tenant table."""
    exprs = [F.col("id").alias("tenant_id")]
    for c in cols:
        exprs.append(F.col(c).alias("tenant_name" if c == "name" else c))
    return tenants.select(*exprs)
