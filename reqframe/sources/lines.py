"""JSON-lines files as DataFrames, with line numbers that need no shuffle of the rows."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reqframe.functions.jsonlines import is_blank
from reqframe.session import plan_bytes
from reqframe.sources.literal import literal_rows

# A task id sits above this bit of monotonically_increasing_id, the row in the task below it.
_TASK_BITS = 33

# One row of about 200 bytes per scan split: a million of them is a broadcast of 200 MB and
# stands for 128 TB at the default split size. Larger scans join by shuffle instead.
MAX_BROADCAST_SPLITS = 1_000_000


def is_dir(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(hadoop_path):
        raise FileNotFoundError(path)
    return fs.getFileStatus(hadoop_path).isDirectory()


def _children(spark: SparkSession, path: str) -> list[str]:
    """The files of a folder that hold lines: ``*.jsonl``, else the parts that a line sink wrote; not those below."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    names = {s.getPath().getName(): s.getPath().toString() for s in fs.listStatus(hadoop_path) if s.isFile()}
    for shape in (r".*\.jsonl", r"part.*\.txt"):
        if chosen := sorted(n for n in names if re.fullmatch(shape, n, re.DOTALL) and not n.startswith((".", "_"))):
            return [names[n] for n in chosen]
    return []


def _as_named(path: str) -> str:
    """The path as a pattern that means itself."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def _decoded(uri: Column) -> Column:
    """The path that a file's URI spells. A plus sign means itself."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def scan_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Raw lines of one file, of a directory's ``*.jsonl`` children, or of several files.

    A directory without such files is read by the ``part*.txt`` children that a line sink wrote, in their order. Only
    the directory itself is listed. Characters that a pattern would give a meaning (``[``, ``*``) are part of the names.

    Columns: ``file`` (path as it is named, not its URI), ``block`` (byte offset of the scan split) and ``raw``. Lines
    end at ``\\n``; one trailing ``\\r`` is dropped.
    """
    if not isinstance(path, str):
        paths = list(dict.fromkeys(path))
        if any([is_dir(spark, p) for p in paths]):
            raise IsADirectoryError("a list of paths must name files")
    else:
        paths = _children(spark, path) if is_dir(spark, path) else [path]
    if not paths:
        raise ValueError(f"no .jsonl files found in {path}")
    text = spark.read.option("lineSep", "\n").text([_as_named(p) for p in paths])
    return text.select(
        _decoded(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.expr(r"CASE WHEN endswith(value, '\r') THEN left(value, length(value) - 1) ELSE value END").alias("raw"),
    )


def _input_files(scan: DataFrame) -> list[str]:
    """The scan's files, spelled as the ``file`` column spells them (no empty authority)."""
    return sorted(unquote(f).replace(":///", ":/", 1) for f in scan.inputFiles())


def file_list(scan: DataFrame) -> DataFrame:
    """The files behind a scan, empty ones included, as the driver already lists them."""
    spark = scan.sparkSession
    return literal_rows(spark, [(f,) for f in _input_files(scan)], "file string")


def _split_count(scan: DataFrame) -> int:
    """Upper estimate of a scan's splits from what the driver knows of its files."""
    conf = scan.sparkSession.conf
    size = conf.get("spark.sql.files.maxPartitionBytes", "128m")
    split = int(
        scan.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)
    )
    parallel = scan.sparkSession.sparkContext.defaultParallelism
    total = plan_bytes(scan)
    return len(scan.inputFiles()) + total // max(1, min(split, total // parallel + 1)) + parallel


def _given_order(scan: DataFrame, paths: Sequence[str]) -> DataFrame:
    """``(file, file_ord)`` in argument order; a path given twice appears twice."""
    spark = scan.sparkSession
    name = {p: _input_files(spark.read.text(_as_named(p)))[0] for p in dict.fromkeys(paths)}
    rows = [(name[p], i) for i, p in enumerate(paths)]
    return literal_rows(spark, rows, "file string, file_ord int")


def index_rows(
    scan: DataFrame, kept: Column | None = None, order: Sequence[str] | None = None
) -> DataFrame:
    """Number the rows of a file scan that carries ``file`` and ``block``; drop those not kept.

    Adds ``file_ord`` (0-based, by path or by the given paths), ``line`` (1-based, dropped rows
    counted), ``pos`` (0-based in the file, dropped rows skipped) and ``seq`` (``pos`` carried on
    over the files in order).

    A first job counts the rows of each scan split: one output row per split. Prefix sums over
    that small table give each split its starting numbers, and those are joined back onto the
    scan. Rows stay where they were read; nothing but the per-split counts is shuffled.
    """
    kept = F.lit(True) if kept is None else kept
    stamped = scan.withColumn("_id", F.monotonically_increasing_id())
    splits = stamped.groupBy("file", "block").agg(
        F.min("_id").alias("_first"),
        F.count(F.lit(1)).alias("_lines"),
        F.count_if(kept).alias("_kept"),
    )

    def before(column: str, window) -> Column:
        window = window.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    in_file = Window.partitionBy("file").orderBy("block")
    in_task = Window.partitionBy(F.shiftright("_first", _TASK_BITS)).orderBy("_first")
    starts = splits.select(
        "file",
        "block",
        "_first",
        before("_lines", in_file).alias("_line0"),
        before("_kept", in_file).alias("_pos0"),
        before("_kept", in_task).alias("_task0"),
    )
    # One row per file from here: the list the driver itself made for the scan.
    files = splits.groupBy("file").agg(F.sum("_kept").alias("_kept"))
    if order is None:
        files = files.withColumn("file_ord", F.row_number().over(Window.orderBy("file")) - 1)
    else:
        files = files.join(F.broadcast(_given_order(scan, order)), "file")
    files = files.select(
        "file", "file_ord", before("_kept", Window.orderBy("file_ord")).alias("_seq0")
    )
    starts = starts.join(files, "file")
    if _split_count(scan) <= MAX_BROADCAST_SPLITS:
        starts = F.broadcast(starts)

    rows = stamped.where(kept).withColumn("_kept_id", F.monotonically_increasing_id())
    row_in_task = F.col("_kept_id").bitwiseAND(F.lit((1 << _TASK_BITS) - 1))
    pos = row_in_task - F.col("_task0") + F.col("_pos0")
    return rows.join(starts, ["file", "block"]).select(
        "file",
        "file_ord",
        (F.col("_id") - F.col("_first") + F.col("_line0") + 1).alias("line"),
        pos.alias("pos"),
        (pos + F.col("_seq0")).alias("seq"),
        *[c for c in scan.columns if c not in ("file", "block")],
    )


def index_lines(scan: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """:func:`index_rows` of a text scan; white-space-only lines count as lines but are dropped."""
    return index_rows(scan, ~is_blank("raw"), order)


def read_lines(spark: SparkSession, path: str | Sequence[str], index: bool = True) -> DataFrame:
    """Non-blank lines of a request set: ``file, file_ord, line, pos, seq, raw``.

    Without ``index`` only ``file`` and ``raw`` are there and one pass is enough. Operators parse
    the lines when they need to; parse them yourself (``parse_lines``) to share one parse.
    """
    scan = scan_lines(spark, path)
    if not index:
        return scan.where(~is_blank("raw")).select("file", "raw")
    return index_lines(scan, None if isinstance(path, str) else path)
