"""Records out of JSON arrays that are too large for one row.

A file is read as pieces that end with a closing brace, in byte ranges, so no
task sees it whole. What a piece does to the reader's state, whether it is inside of a
string and how many brackets are open, is known for either way it may begin:
pieces compose. Prefix sums over the pieces of a unit, so many pieces of a range, and over the units tell
each piece's state, hence where records end, and the pieces of a record are put together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.session import materialize, tasks_for

#: So many units are broadcast at most; more are joined by shuffling.
BROADCAST_RANGES = 1_000_000
#: Pieces of a unit, a power of two: what one window holds, however long the byte ranges are.
UNIT_PIECES = 1 << 14
#: Bytes of text that one task sorts; a piece takes about eight times its bytes there.
TASK_BYTES = 16 << 20


def _depth(segments: Column, first: int) -> Column:
    """Opened minus closed brackets in every other segment: what lies outside of strings."""
    outside = F.array_join(F.filter(segments, lambda _, i: i % 2 == first), "")
    # Taking the closed ones off leaves the longer text, the more are open.
    return F.length(F.translate(outside, "]}", "")) - F.length(F.translate(outside, "[{", ""))


def _pieces(read: DataFrame) -> DataFrame:
    """file, block (a unit of a byte range), pos, piece, closed, odd, outer, inner: the pieces in order, and what each does to the state.

    ``closed``: a brace follows the piece. ``outer`` and ``inner``: its change of
    depth, the brace included, if it begins outside or inside of a string.
    """
    rows = read.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range"),
        F.col("_metadata.file_size").alias("file_size"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("piece"),
    )
    unit = F.shiftright("pos", UNIT_PIECES.bit_length() - 1)
    rows = rows.withColumn("block", F.struct("range", unit.alias("unit"))).drop("range")
    # A brace ends every piece, so none begins with an escaped character.
    rows = rows.withColumn("_segments", F.split(F.regexp_replace("piece", r"\\.", ""), '"', -1))
    segments = F.col("_segments")
    odd = (F.size(segments) - 1) % 2
    rows = rows.withColumns({"odd": odd, "outer": _depth(segments, 0), "inner": _depth(segments, 1)}).drop("_segments")
    rows = materialize(rows, "json-pieces")
    # The last piece of a file has a brace only if the bytes add up so.
    # By units first: the greatest of structs is found by sorting.
    units = rows.groupBy("file", "block").agg(
        F.max("pos").alias("pos"), F.sum(F.octet_length("piece") + 1).alias("_bytes"), F.max("file_size").alias("file_size")
    )
    bytes_ = units.groupBy("file").agg(F.max(F.struct("block", "pos")).alias("_last"), (F.sum("_bytes") == F.max("file_size")).alias("_whole"))
    bytes_ = materialize(bytes_, "json-files")
    # A large file's pieces would all meet in one task if they were joined by its name.
    if bytes_.count() <= BROADCAST_RANGES:
        bytes_ = F.broadcast(bytes_)
    closed = (F.struct("block", "pos") != F.col("_last")) | F.col("_whole")
    return rows.drop("file_size").join(bytes_, "file").withColumn("closed", closed).drop("_last", "_whole")


def split_large_array(spark: SparkSession, path: str, depth: int = 1) -> DataFrame:
    """file, record_no (from 1), record: the text of every object at ``depth`` of the documents under ``path``.

    Depth 1: the elements of an array of records; 2: those of an array of pages that are
    arrays. What stands between two objects, such as a
    stray value, stays with the one after it, so that nothing is lost: brackets and commas are taken off,
    and a text that then isn't JSON shows there was more. A trailing text without an object is a record as well.
    A record is one row; a file may be of any size, as long as it has records.
    """
    read = spark.read.option("lineSep", "}").option("recursiveFileLookup", True).text(path)
    tasks = tasks_for(TASK_BYTES, read)
    inside = Window.partitionBy("file", "block").orderBy("pos")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    rows = _pieces(read).repartition(tasks, "file", "block").withColumn("_flips", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    # How a piece that ends within a string, or outside of one, counts its brace.
    ends_in = lambda start: (start + F.col("odd")) % 2
    change = lambda start: F.when(start == 0, F.col("outer")).otherwise(F.col("inner")) - F.when(F.col("closed") & (ends_in(start) == 0), 1).otherwise(0)
    rows = rows.withColumns({"_if_out": change(F.col("_flips")), "_if_in": change(1 - F.col("_flips"))})
    rows = materialize(rows, "json-states")
    over_blocks = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("file", "block").agg(F.sum("odd").alias("_odd"), F.sum("_if_out").alias("_out"), F.sum("_if_in").alias("_in"))
    blocks = blocks.withColumn("_begins", F.coalesce(F.sum("_odd").over(over_blocks), F.lit(0)) % 2)
    moved = F.when(F.col("_begins") == 0, F.col("_out")).otherwise(F.col("_in"))
    blocks = blocks.withColumn("_moved", moved).withColumn("_depth", F.coalesce(F.sum("_moved").over(over_blocks), F.lit(0)))
    blocks = materialize(blocks.select("file", "block", "_begins", "_depth"), "json-blocks")
    few = blocks.count() <= BROADCAST_RANGES
    placed = rows.join(F.broadcast(blocks) if few else blocks, ["file", "block"]).repartition(tasks, "file", "block")
    start = (F.col("_begins") + F.col("_flips")) % 2
    placed = placed.withColumn("_change", F.when(F.col("_begins") == 0, F.col("_if_out")).otherwise(F.col("_if_in")))
    placed = placed.withColumn("_after", F.col("_depth") + F.sum("_change").over(inside))
    last = F.col("closed") & (ends_in(start) == 0) & (F.col("_after") == depth)
    placed = placed.withColumn("_last", last.cast("int")).withColumn("_done", F.coalesce(F.sum("_last").over(before), F.lit(0)))
    placed = materialize(placed.select("file", "block", "pos", "piece", "closed", "_last", "_done"), "json-placed")
    counts = placed.groupBy("file", "block").agg(F.sum("_last").alias("_n"))
    counts = counts.select("file", "block", F.coalesce(F.sum("_n").over(over_blocks), F.lit(0)).alias("_earlier"))
    numbered = placed.join(F.broadcast(counts) if few else counts, ["file", "block"])
    text = F.when(F.col("closed"), F.concat("piece", F.lit("}"))).otherwise(F.col("piece"))
    numbered = numbered.select("file", (F.col("_earlier") + F.col("_done") + 1).alias("record_no"), "block", "pos", text.alias("text"), "_last")
    made = numbered.repartition(tasks, "file", "record_no").groupBy("file", "record_no").agg(
        F.array_sort(F.collect_list(F.struct("block", "pos", "text"))).alias("parts"), F.max("_last").alias("_whole")
    )
    joined = made.select("file", "record_no", F.array_join("parts.text", "").alias("record"), "_whole")
    stripped = joined.withColumn("record", F.regexp_replace("record", r"^[\s,\[\]]+", ""))
    # What follows the last record is closing brackets, or the rest of the object around it.
    rest = F.regexp_replace("record", r"[\s,\[\]}]+", "")
    return stripped.filter((F.col("_whole") == 1) | (rest != "")).select("file", "record_no", "record")
