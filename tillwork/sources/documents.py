"""One huge JSON document as JSON Lines, without any task reading it whole.

A multi-line JSON file cannot be split by the reader, for whether a byte lies in a string, and how deep,
depends on all bytes before it. Here the file is read in byte ranges, as pieces that end at a closing brace.
A piece says for each of the two states it may start in, outside a string or inside, how the depth changes.
Ranges are summed up for both states, the few rows of ranges are stitched in order, and only then is it known
where each piece stands. A record ends at a brace outside strings that closes an element of the outer array.

A document is one array of objects, or objects one after the other, in UTF-8. Line ends between tokens become
blanks; nothing else in a record changes, duplicate keys and unknown fields included. An empty file or array has
no records. A document that is cut off, or whose elements are not objects, is an error. Compressed files are
read by one task each, as everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwork.session import remove_scratch, scratch_path

_FILE = ["_file", "_range"]


def _count(text: Column, signs: str) -> Column:
    return F.length(text) - F.length(F.translate(text, signs, ""))


def _depth(text: Column) -> Column:
    """The change of depth over a text that starts outside strings and has no escapes, and over the brace
    that ends its piece unless that lies in a string."""
    bare = F.regexp_replace(text, r'"[^"]*("|$)', "")
    closed = F.when(_count(text, '"') % 2 == 0, -1).otherwise(0)
    return _count(bare, "{[") - _count(bare, "}]") + closed


def pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The pieces of the files: where they stand, quotes, and the change of depth from either state.

    ``_out`` holds it for a piece that starts outside strings, ``_in`` for one that starts inside.
    """
    rows = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_range"),
        F.col("_metadata.file_size").alias("_size"),
        F.monotonically_increasing_id().alias("_at"),
        F.col("value").alias("_text"),
    )
    # A piece follows a brace, so no escape reaches over its start.
    plain = F.regexp_replace("_text", r"(?s)\\.", "")
    quoted = F.regexp_replace(plain, r'^[^"]*("|$)', "")
    inside = F.when(_count(plain, '"') > 0, _depth(quoted)).otherwise(0)
    return rows.withColumns(
        {"_quotes": _count(plain, '"') % 2, "_out": _depth(plain), "_in": inside}
    )


def _before(name: str, window) -> Column:
    return F.coalesce(F.sum(name).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _placed(rows: DataFrame) -> DataFrame:
    """Pieces with the depth after them, and whether a brace outside strings ends them."""
    order = Window.partitionBy(*_FILE).orderBy("_at")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    odd = _before("_quotes", order) % 2 == 1
    # Both ways: for a range that starts outside a string, and for one that starts inside.
    rows = rows.withColumn("_odd", odd).withColumns(
        {
            "_if_out": F.sum(F.when(F.col("_odd"), F.col("_in")).otherwise(F.col("_out"))).over(upto),
            "_if_in": F.sum(F.when(F.col("_odd"), F.col("_out")).otherwise(F.col("_in"))).over(upto),
        }
    )
    path = scratch_path(rows.sparkSession, "pieces")
    rows.write.parquet(path)
    rows = rows.sparkSession.read.parquet(path)

    ranges = rows.groupBy(*_FILE).agg(
        (F.sum("_quotes") % 2).alias("_quotes"),
        F.max_by("_if_out", "_at").alias("_if_out"),
        F.max_by("_if_in", "_at").alias("_if_in"),
        F.min_by(F.substring(F.ltrim(F.regexp_replace("_text", r"^[\s\uFEFF]+", "")), 1, 1), "_at").alias("_sign"),
        F.max("_at").alias("_last"),
        F.sum(F.octet_length("_text") + 1).alias("_read"),
        F.first("_size").alias("_size"),
    )
    # One row a range: a file of a terabyte has some eight thousand.
    whole = Window.partitionBy("_file")
    order = whole.orderBy("_range")
    ranges = ranges.withColumn("_inside", _before("_quotes", order) % 2 == 1)
    ranges = ranges.withColumn("_change", F.when(F.col("_inside"), F.col("_if_in")).otherwise(F.col("_if_out")))
    ranges = ranges.select(
        *_FILE,
        "_inside",
        _before("_change", order).alias("_depth"),
        F.first("_sign").over(order).alias("_sign"),
        "_last",
        F.max("_range").over(whole).alias("_last_range"),
        # The last piece has no brace where it makes the file one byte longer than it is.
        (F.sum("_read").over(whole) > F.first("_size").over(whole)).alias("_unclosed"),
    )
    return rows.join(ranges, _FILE).select(
        *_FILE,
        "_at",
        "_text",
        "_sign",
        (F.col("_depth") + F.when(F.col("_inside"), F.col("_if_in")).otherwise(F.col("_if_out"))).alias("_after"),
        (F.col("_odd") == (F.col("_inside") != (F.col("_quotes") == 1))).alias("_closed"),
        (F.col("_unclosed") & (F.col("_range") == F.col("_last_range")) & (F.col("_at") == F.col("_last"))).alias(
            "_rest"
        ),
    )


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The records of the documents: file, number from 0 in its order, and JSON text on one line."""
    outer = F.when(F.col("_sign") == "[", 1).otherwise(0)
    rows = _placed(pieces(spark, path)).withColumn(
        "_ends", (F.col("_closed") & ~F.col("_rest") & (F.col("_after") == outer)).cast("int")
    )
    order = Window.partitionBy(*_FILE).orderBy("_at")
    rows = rows.withColumn("_number", _before("_ends", order))
    landed = scratch_path(spark, "placed")
    rows.write.parquet(landed)
    rows = spark.read.parquet(landed)

    ranges = rows.groupBy(*_FILE).agg(F.sum("_ends").alias("_ends"))
    ranges = ranges.select(*_FILE, _before("_ends", Window.partitionBy("_file").orderBy("_range")).alias("_first"))
    # A group is one record, whichever ranges it lies in.
    groups = (
        rows.join(ranges, _FILE)
        .groupBy("_file", (F.col("_first") + F.col("_number")).alias("number"))
        .agg(
            F.array_sort(F.collect_list(F.struct("_range", "_at", "_text"))).alias("_parts"),
            F.max("_ends").alias("_ends"),
            F.first("_sign").alias("_sign"),
        )
    )
    text = F.array_join(F.transform("_parts", lambda p: p["_text"]), "}")
    element = F.concat(F.regexp_replace(text, r"^[\s\uFEFF]*[\[,]?\s*", ""), F.lit("}"))
    element = F.regexp_replace(element, r"[\r\n]+", " ")
    array = F.col("_sign") == "["
    rest_is_end = F.when(array, text.rlike(r"^[\s\uFEFF]*\[?\s*\]\s*$")).otherwise(text.rlike(r"^[\s\uFEFF]*$"))
    value = (
        F.when((F.col("_ends") == 1) & element.startswith("{"), element)
        .when(F.col("_ends") == 1, F.raise_error(F.concat(F.lit("no object in "), F.col("_file"))))
        .when(rest_is_end, F.lit(None).cast("string"))
        .otherwise(F.raise_error(F.concat(F.lit("document is cut off: "), F.col("_file"))))
    )
    return groups.select(F.col("_file").alias("file"), "number", value.alias("value"), array.alias("_array"))


def land_documents(spark: SparkSession, path: str | list[str], out: str, mode: str = "errorifexists") -> int:
    """Write the records of JSON documents as JSON Lines; their number.

    ``read_json(spark, out, multi_line=False)`` reads them, by as many tasks as the size asks for.
    """
    staged = scratch_path(spark, "records")
    records(spark, path).write.parquet(staged)
    rows = spark.read.parquet(staged)
    # An array that ends has a last row without a record: what follows its last element.
    open_ends = rows.where("_array").groupBy("file").agg(F.count_if(F.col("value").isNull()).alias("n")).where("n = 0")
    if not open_ends.isEmpty():
        raise ValueError(f"document is cut off: {open_ends.first()['file']}")
    rows.where("value IS NOT NULL").select("value").write.mode(mode).text(out)
    count = rows.where("value IS NOT NULL").count()
    remove_scratch(spark, staged)
    return count
