"""Sales and activity built up from several deliveries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwork.plans.incremental import customer_activity, deliver_activity, deliver_sales
from tillwork.session import scratch_path
from workload.entities import SALES_SQL, sales
from workload.registry import iso, query
from workload.sales_queries import ACTIVITY_SQL, SALES_COLUMNS, activity_iso, typed


@query(f"WITH {SALES_SQL} SELECT {SALES_COLUMNS} FROM sales")
def sales_delivered(spark, sf_dir):
    """Sales in three deliveries that overlap, the last all of them once more."""
    root = scratch_path(spark, "deliveries")
    rows = sales(spark, sf_dir)
    early = rows.where("CAST(split_part(OrderDate, '/', 3) AS INT) < 1995")
    for delivery in (early, rows.where("OrderQuantity > 25"), rows):
        landed = deliver_sales(delivery, root)
    return landed.select(iso("OrderDate"), *[c for c in landed.columns if c != "OrderDate"])


@query(ACTIVITY_SQL)
def activity_delivered(spark, sf_dir):
    """Activity after three deliveries; the second brings lines of other dates, which the third takes
    back while it brings the rest."""
    root = scratch_path(spark, "activity")
    rows = typed(spark, sf_dir)
    wrong = rows.where("OrderQuantity = 50").withColumn("OrderDate", F.date_add("OrderDate", 40))
    deliver_activity(rows.where("OrderQuantity < 20"), root)
    deliver_activity(rows.where("OrderQuantity BETWEEN 20 AND 40").unionByName(wrong), root)
    deliver_activity(rows.where("OrderQuantity > 40"), root, removed=wrong)
    return activity_iso(customer_activity(spark, root, rows.schema))
