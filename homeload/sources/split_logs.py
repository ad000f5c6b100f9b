"""One call log of any size, read in splits: a lexer by parallel prefix.

The log is read as fragments that end at ``}``, which any split of the file can
find by itself. What a fragment does depends on whether it begins inside a
string, so it carries both answers: its map from (depth, in a string) at its
start to that at its end. Maps of the fragments of a split compose to the map
of the split, one row each; these are scanned in order, and every fragment then
knows where it stands. Where a brace closes at depth 1 outside a string, an
entry of the log ends. Escapes never reach over a fragment's end in JSON, as
``}`` has none.

No text longer than an entry is ever one value, and the rows do not depend on
where the file was split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from homeload import schemas
from homeload.functions import text
from homeload.session import written
from homeload.sources.call_logs import Paths

CLOSE = "}"
SPLIT = ("log_file", "block")
SIZE = "spark.sql.files.maxPartitionBytes"
#: Bytes a task reads at least, in as many splits as they are.
TASK_BYTES = 8 << 20
_WS = r"[ \t\r\n]*"


def _count(body: Column, letters: str) -> Column:
    return F.length(body) - F.length(F.translate(body, letters, ""))


def _depth_change(parts: Column, odd: int) -> Column:
    """Brackets opened less closed in every other part between quotes."""
    outside = F.array_join(F.filter(parts, lambda _, i: i % 2 == odd), "")
    return _count(outside, "[{") - _count(outside, "]}")


def fragments(spark: SparkSession, paths: Paths, split_bytes: int | None = None) -> DataFrame:
    """``log_file, block, row, value`` with the map of each fragment.

    ``quotes`` is 1 where the fragment changes between inside and outside of a
    string; ``outside`` and ``inside`` are its change of depth, its closing
    brace not counted, if it begins there. Small splits, of ``split_bytes`` as
    the session has it now, share a task, one after another.
    """
    raw = spark.read.option("lineSep", CLOSE).text(paths if isinstance(paths, str) else list(paths))
    rows = raw.select(
        F.col("_metadata.file_path").alias("log_file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("file_size"), "value",
    )
    if split_bytes is not None and split_bytes < TASK_BYTES:
        rows = rows.coalesce(max(1, -(-rows.rdd.getNumPartitions() * split_bytes // TASK_BYTES)))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    parts = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"', -1)
    rows = rows.withColumn("parts", parts)
    return rows.select(
        *SPLIT, "file_size", "row", "value", ((F.size("parts") - 1) % 2).alias("quotes"),
        _depth_change(F.col("parts"), 0).alias("outside"), _depth_change(F.col("parts"), 1).alias("inside"),
    )


def _in_split(rows: DataFrame) -> DataFrame:
    """Fragments with the composed map from the start of their split to their own end: ``flips`` and both depths."""
    upto = Window.partitionBy(*SPLIT).orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("flips", F.sum("quotes").over(upto) % 2)
    began = (F.col("flips") + F.col("quotes")) % 2  # in a string at the fragment's start, if not at the split's
    # the closing brace counts outside of strings
    from_outside = F.when(began == 0, F.col("outside")).otherwise(F.col("inside")) - F.when(F.col("flips") == 0, 1).otherwise(0)
    from_inside = F.when(began == 0, F.col("inside")).otherwise(F.col("outside")) - F.when(F.col("flips") == 0, 0).otherwise(1)
    return rows.withColumns({"depth_outside": F.sum(from_outside).over(upto), "depth_inside": F.sum(from_inside).over(upto)})


def _split_starts(rows: DataFrame) -> DataFrame:
    """Per split ``in_string, depth`` at its start, and ``open_row``: the log's last fragment, if no brace closes it."""
    last = lambda c: F.max_by(c, "row").alias(c)
    splits = rows.groupBy(*SPLIT).agg(
        last("flips"), last("depth_outside"), last("depth_inside"), F.max("row").alias("last_row"), F.max("file_size").alias("file_size"),
        F.sum(F.octet_length("value") + 1).alias("bytes"),
    )
    order = Window.partitionBy("log_file").orderBy("block")
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("log_file")
    splits = splits.withColumn("in_string", F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2)
    own = F.when(F.col("in_string") == 0, F.col("depth_outside")).otherwise(F.col("depth_inside"))
    unclosed = (F.sum("bytes").over(whole) > F.col("file_size")) & (F.lead("block").over(order).isNull())
    return splits.select(
        *SPLIT, "in_string", F.coalesce(F.sum(own).over(before), F.lit(0)).alias("depth"), F.when(unclosed, F.col("last_row")).alias("open_row")
    )


def _written_fragments(spark: SparkSession, paths: Paths, split_bytes: int | None) -> DataFrame:
    """Fragments with the map of their split; only the logs are read in splits of ``split_bytes``, not what comes of them."""
    before = spark.conf.get(SIZE)
    try:
        if split_bytes is not None:
            spark.conf.set(SIZE, split_bytes)
        return written(_in_split(fragments(spark, paths, split_bytes)), "log-fragments")
    finally:
        spark.conf.set(SIZE, before)


def entries(spark: SparkSession, paths: Paths, split_bytes: int | None = None) -> DataFrame:
    """``log_file, closed, body``: every entry with what separates it from the one before, and the rest behind the last one.

    ``closed`` tells entries from the rest.
    """
    rows = _written_fragments(spark, paths, split_bytes)
    placed = rows.join(_split_starts(rows), list(SPLIT))
    ends_outside = (F.col("in_string") + F.col("flips")) % 2 == 0
    depth = F.col("depth") + F.when(F.col("in_string") == 0, F.col("depth_outside")).otherwise(F.col("depth_inside"))
    has_brace = ~F.coalesce(F.col("row") == F.col("open_row"), F.lit(False))
    placed = placed.select(
        *SPLIT, "row", F.concat("value", F.when(has_brace, CLOSE).otherwise("")).alias("value"),
        (has_brace & ends_outside & (depth == 1)).cast("int").alias("ends"),
    )
    # an entry is named by the split it ends in and its number there
    after = Window.partitionBy(*SPLIT).orderBy("row").rowsBetween(0, Window.unboundedFollowing)
    placed = placed.withColumn("left", F.sum("ends").over(after))
    counts = placed.groupBy(*SPLIT).agg(F.sum("ends").alias("n"))
    later = Window.partitionBy("log_file").orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    following = F.min(F.when(F.col("n") > 0, F.struct("block", "n"))).over(later)
    named = placed.join(counts.withColumn("following", following), list(SPLIT))
    here = F.struct(F.col("block"), F.col("left").alias("n"))
    named = named.withColumn("entry", F.when(F.col("left") > 0, here).otherwise(F.col("following")))
    pieces = F.sort_array(F.collect_list(F.struct("block", "row", "value")))
    whole = named.groupBy("log_file", "entry").agg(F.array_join(F.transform(pieces, lambda p: p["value"]), "").alias("body"))
    return whole.select("log_file", F.col("entry").isNotNull().alias("closed"), "body")


def read_split_logs(spark: SparkSession, paths: Paths, split_bytes: int | None = None) -> DataFrame:
    """One row per call of all logs, with ``log_file``: the rows of ``call_logs.read_call_logs``, whatever a log's size.

    A log is a JSON array of objects, whole or cut off between two of them, and
    gives no rows if any part of it is something else. Splits are of
    ``split_bytes``, else as large as ``spark.sql.files.maxPartitionBytes`` says;
    a compressed log cannot be split. The
    text passes through ``spark.checkpoint.dir`` twice, as fragments and as
    entries.
    """
    found = entries(spark, paths, split_bytes)
    lead = F.col("body").rlike(rf"^(\s*\[|{_WS},){_WS}\{{")
    value = F.substr("body", F.instr("body", "{"))
    rest = F.col("body").rlike(rf"^(\s*|{_WS},\s*|{_WS}\]\s*)\z")
    judged = found.select(
        "log_file", "closed", F.when(F.col("closed"), value).alias("value"),
        F.when(F.col("closed"), lead & text.is_json(value)).otherwise(rest).alias("ok"),
    )
    judged = written(judged, "log-entries")
    whole = judged.groupBy("log_file").agg(F.bool_and("ok").alias("ok")).where("ok").select("log_file")
    calls = judged.where("closed").join(whole, "log_file", "left_semi")
    return calls.select("log_file", F.from_json("value", schemas.API_CALL, schemas.ANY_LENGTH).alias("c")).select("log_file", "c.*")
