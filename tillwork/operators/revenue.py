"""Priced revenue: sales joined with products by a foreign key.

Money is exact: prices become decimals, so sums do not depend on how rows are dealt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

#: What a broadcast side may measure, in bytes of its values.
BROADCAST_BYTES = 32 << 20
#: A key with more than this share of the rows is hot; at most 1 / HOT_SHARE keys are.
HOT_SHARE = 0.01
#: Tasks a hot key is spread over.
SPLITS = 64

#: What became of a sale's price.
PRICED, UNKNOWN, AMBIGUOUS, UNPRICED = "priced", "unknown product", "several prices", "no price"


def value_bytes(df: DataFrame) -> int:
    """The bytes of all values, measured: 8 for a fixed-size one, the length of a text."""
    sizes = [
        F.coalesce(F.octet_length(name), F.lit(0)) if kind in ("string", "binary") else F.lit(8)
        for name, kind in df.dtypes
    ]
    total = sizes[0].cast("long")
    for size in sizes[1:]:
        total = total + size
    return df.agg(F.coalesce(F.sum(total), F.lit(0))).first()[0]


def hot_keys(facts: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys that hold more than ``share`` of all rows: at most ``1 / share``, counted in each task
    before the shuffle. A NULL key joins nothing and so is never hot."""
    counts, whole = facts.groupBy(key).agg(F.count("*").alias("_n")), Observation()
    # One pass over the facts: the total comes with the most frequent keys, among which all hot ones are.
    most = counts.observe(whole, F.sum("_n").alias("total")).orderBy(F.desc("_n")).limit(int(1 / share) + 1)
    rows = most.select(key, "_n").collect()
    return [row[0] for row in rows if row[0] is not None and row[1] > share * whole.get["total"]]


def lookup(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_share: float = HOT_SHARE,
    splits: int = SPLITS,
) -> DataFrame:
    """Every fact with its dimension row; ``_known`` is false where the key is missing there.

    ``dimension`` has one row per key, and no other column of the facts' names. It is broadcast if it
    measures little enough. Otherwise both sides are shuffled, and the rows of a hot key are spread
    over ``splits`` tasks by a hash of the row, with as many copies of its one dimension row.
    """
    dimension = dimension.withColumn("_known", F.lit(True))
    known = F.coalesce("_known", F.lit(False))
    if value_bytes(dimension) <= broadcast_bytes:
        return facts.join(F.broadcast(dimension), key, "left").withColumn("_known", known)
    hot = hot_keys(facts, key, hot_share)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False)) if hot else F.lit(False)
    # Rows without a key join nothing: their spread is free.
    spread = is_hot | F.col(key).isNull()
    part = F.when(spread, F.pmod(F.xxhash64(*facts.columns), F.lit(splits))).otherwise(0).cast("int")
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(splits - 1))).otherwise(F.array(F.lit(0)))
    copied = dimension.withColumn("_part", F.explode(copies))
    joined = facts.withColumn("_part", part).join(copied, [key, "_part"], "left").drop("_part")
    return joined.withColumn("_known", known)


def money(amount: Column) -> Column:
    """An amount to four places, exactly."""
    return amount.cast("decimal(18,4)")


def product_prices(products: DataFrame) -> DataFrame:
    """One row per product key: its price, and whether it has several."""
    price = money(F.col("ProductPrice"))
    return (
        products.where(F.col("ProductKey").isNotNull())
        .groupBy("ProductKey")
        .agg(F.min(price).alias("UnitPrice"), (F.min(price) != F.max(price)).alias("_several"))
    )


def priced_sales(sales: DataFrame, products: DataFrame, **how) -> DataFrame:
    """Every sale with ``UnitPrice``, ``Revenue`` and ``PriceStatus``; ``how`` as for ``lookup``.

    No sale is lost: one whose product is unknown, has no price or has several prices has NULL
    revenue, and its status says why.
    """
    joined = lookup(sales, product_prices(products), "ProductKey", **how)
    several = F.coalesce("_several", F.lit(False))
    status = (
        F.when(~F.col("_known"), UNKNOWN)
        .when(several, AMBIGUOUS)
        .when(F.col("UnitPrice").isNull(), UNPRICED)
        .otherwise(PRICED)
    )
    price = F.when(~several, F.col("UnitPrice"))
    revenue = (price * F.col("OrderQuantity")).cast("decimal(28,4)")
    return joined.select(
        *sales.columns, price.alias("UnitPrice"), revenue.alias("Revenue"), status.alias("PriceStatus")
    )


def _units_by(sales: DataFrame, *groups: str) -> DataFrame:
    """Sales summed per group and product before any join: one product's many lines become few rows."""
    return sales.groupBy(*groups, "ProductKey").agg(F.sum("OrderQuantity").alias("OrderQuantity"))


def revenue_by(sales: DataFrame, products: DataFrame, *groups: str, **how) -> DataFrame:
    """Per group: ``revenue`` of priced sales, their ``units``, and ``unpriced_units`` of the others."""
    priced = priced_sales(_units_by(sales, *groups), products, **how)
    is_priced = F.col("PriceStatus") == PRICED
    return priced.groupBy(*groups).agg(
        F.sum("Revenue").alias("revenue"),
        F.sum(F.when(is_priced, F.col("OrderQuantity"))).alias("units"),
        F.sum(F.when(~is_priced, F.col("OrderQuantity"))).alias("unpriced_units"),
    )


def revenue_by_year_month(sales: DataFrame, products: DataFrame, **how) -> DataFrame:
    """``revenue_by`` year and month of the typed ``OrderDate``; sales without a date are a group."""
    dated = sales.withColumns({"Year": F.year("OrderDate"), "Month": F.month("OrderDate")})
    return revenue_by(dated, products, "Year", "Month", **how)


def mean_revenue(sales: DataFrame, products: DataFrame, group: str, name: str, **how) -> DataFrame:
    """One row: the mean revenue of a group (an order, a date), over groups with a priced sale."""
    per_group = revenue_by(sales, products, group, **how)
    return per_group.agg(
        (F.sum("revenue").cast("double") / F.count("revenue")).alias(name),
    )


def unpriced_products(sales: DataFrame, products: DataFrame, **how) -> DataFrame:
    """Keys that could not be priced: why, and the lines and units they leave out."""
    per_key = sales.groupBy("ProductKey").agg(
        F.count("*").alias("lines"), F.sum("OrderQuantity").alias("OrderQuantity")
    )
    return (
        priced_sales(per_key, products, **how)
        .where(F.col("PriceStatus") != PRICED)
        .select("ProductKey", "PriceStatus", "lines", F.col("OrderQuantity").alias("units"))
    )
