"""Sinks of lines: as they are, in order, by file, in chunks.

Lines that belong to files of given names are written once to a staging folder below the target, dealt to
parts by their bytes, and written by Spark's own commit protocol, so that a task that is lost or repeated leaves
nothing. Then the finished files get their names, which only moves entries of the file system: ``a.jsonl``, or
``a.00000.jsonl``, ``a.00001.jsonl`` … where a file has more than one part. A job that fails removes the target.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reqframe.session import plan_bytes

#: No part is larger, unless it is one line.
PART_BYTES = 256 << 20
# Lines whose bytes are summed up before anything is ordered, and such blocks that are summed up in turn.
_BLOCK = 4096
# Bytes of Parquet that the sums of blocks may have to be sent to all tasks: some 100,000 blocks.
_SENT = 1 << 20


def write_lines(df: DataFrame, path: str, column: str = "raw") -> None:
    """One line per row, in whatever order the rows are; no shuffle."""
    df.select(F.col(column).alias("value")).write.text(path, lineSep="\n")


def sized_parts(df: DataFrame, name: str, position: str, size: str, working: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """Add ``_part``, a text that tells parts apart: of each ``name`` the lines in ``position`` order, cut by bytes.

    ``position`` are integers from 0, dense or not, that may repeat; a part's lines follow one another. Bytes are
    summed up by blocks of positions, and blocks of blocks, so that no name has to fit in one task; only blocks
    that are too large for a part are cut line by line.

    The blocks are written to ``working``, a new folder, so that their size is known: few of them are sent to the lines, which
    then stay where they are but for those that are cut; many are joined by shuffle.
    """
    half = max(1, part_bytes // 2)
    placed = df.withColumn("_block", F.expr(f"{position} div {_BLOCK}"))
    sums = placed.groupBy(name, "_block").agg(F.sum(size).alias("_bytes")).withColumn("_above", F.expr(f"_block div {_BLOCK}"))

    def before(value: str, group: Sequence[str], order: str) -> Column:
        window = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(value).over(window), F.lit(0))

    above = sums.groupBy(name, "_above").agg(F.sum("_bytes").alias("_all")).withColumn("_start", before("_all", [name], "_above"))
    blocks = sums.withColumn("_within", before("_bytes", [name, "_above"], "_block")).join(above.drop("_all"), [name, "_above"])
    blocks = blocks.select(name, "_block", (F.col("_start") + F.col("_within")).alias("_start"), (F.col("_bytes") > half).alias("_heavy"))
    blocks.write.parquet(working)
    blocks = df.sparkSession.read.schema(blocks.schema).parquet(working)
    located = placed.join(blocks if plan_bytes(blocks) <= _SENT else blocks.hint("merge"), [name, "_block"])

    def key(*columns: Column) -> Column:
        return F.md5(F.concat_ws("/", F.col(name), *columns).cast("binary"))

    light = located.where(~F.col("_heavy")).withColumn("_part", key(F.expr(f"_start div {half}")))
    # a line above half a part is a part of its own; what follows it begins another
    in_block = Window.partitionBy(name, "_block").orderBy(position, size).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    large = F.col(size) > half
    heavy = located.where("_heavy").withColumns({"_upto": F.sum(size).over(in_block), "_large": F.sum(large.cast("int")).over(in_block)})
    cell = F.expr(f"(_start + _upto - {size}) div {half}")
    heavy = heavy.withColumn("_part", key(F.col("_block"), cell, F.col("_large"), large.cast("int")))
    return light.unionByName(heavy.drop("_upto", "_large")).drop("_block", "_start", "_heavy")


class _Folder:
    """A new folder that is complete or not there."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.at = spark, self._path(spark, path)
        self.fs = self.at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        if self.fs.exists(self.at):
            raise FileExistsError(path)
        self.staging = f"{path.rstrip('/')}/_staging"

    @staticmethod
    def _path(spark: SparkSession, *parts: str):
        made = spark._jvm.org.apache.hadoop.fs.Path(parts[0])
        for part in parts[1:]:
            # a colon in a name would be read as a scheme
            made = spark._jvm.org.apache.hadoop.fs.Path(made, spark._jvm.org.apache.hadoop.fs.Path(None, None, part))
        return made

    def child(self, name: str):
        return self._path(self.spark, self.at.toString(), name)

    def finished(self, folder: str):
        """The one file that a task has committed to a folder of the staging area."""
        statuses = self.fs.listStatus(self._path(self.spark, folder))
        files = [s.getPath() for s in statuses if not s.getPath().getName().startswith(("_", "."))]
        if len(files) != 1:
            raise RuntimeError(f"{len(files)} files in {folder}")
        return files[0]

    def __enter__(self) -> _Folder:
        return self

    def __exit__(self, kind, *_) -> None:
        self.fs.delete(self._path(self.spark, self.staging), True)
        if kind is not None:
            self.fs.delete(self.at, True)


def _part_name(name: str, number: int, parts: int) -> str:
    stem, dot, extension = name.rpartition(".")
    if parts == 1:
        return name
    return f"{stem}.{number:05}.{extension}" if dot else f"{name}.{number:05}"


def write_files(
    lines: DataFrame,
    path: str,
    name: str | Column,
    position: str = "seq",
    column: str = "raw",
    part_bytes: int = PART_BYTES,
    empty: Iterable[str] = (),
) -> None:
    """A new folder with a file for each ``name``, its lines in ``position`` order; and ``empty`` ones.

    The driver sees one row for each file it names, never lines. The input is never overwritten: Spark reads lazily,
    and a lost executor would have nothing left to read again.
    """
    spark = lines.sparkSession
    name = F.col(name) if isinstance(name, str) else name
    with _Folder(spark, path) as target:
        staged = f"{target.staging}/lines"
        chosen = lines.select(name.alias("name"), F.col(position).cast("bigint").alias("position"), F.col(column).alias("value"))
        chosen.withColumn("size", F.octet_length("value") + F.lit(1)).write.parquet(staged)
        rows = sized_parts(spark.read.parquet(staged), "name", "position", "size", f"{target.staging}/blocks", part_bytes)
        found = rows.groupBy("name", "_part").agg(F.min("position").alias("first")).orderBy("name", "first", "_part").collect()
        parts = f"{target.staging}/parts"
        placed = rows.repartition(max(1, len(found)), "_part").sortWithinPartitions("_part", "position")
        placed.select("_part", "value").write.partitionBy("_part").text(parts, lineSep="\n")
        count: dict[str, int] = {}
        for r in found:
            count[r["name"]] = count.get(r["name"], 0) + 1
        number: dict[str, int] = {}
        moves = []
        for r in found:
            at = number[r["name"]] = number.get(r["name"], -1) + 1
            moves.append((r["_part"], _part_name(r["name"], at, count[r["name"]])))

        def finish(move: tuple[str, str]) -> None:
            if not target.fs.rename(target.finished(f"{parts}/_part={move[0]}"), target.child(move[1])):
                raise RuntimeError(f"could not name {move[1]}")

        with ThreadPoolExecutor(8) as pool:
            list(pool.map(finish, moves))
        for missing in dict.fromkeys(empty):
            if missing not in count:
                target.fs.create(target.child(missing)).close()


def write_ordered(df: DataFrame, path: str, position: str = "seq", column: str = "raw", part_bytes: int = PART_BYTES) -> None:
    """A new folder with all lines in ``position`` order: ``part-00000.txt``, … by name, no part larger than ``part_bytes``."""
    write_files(df, path, F.lit("part.txt"), position, column, part_bytes)


def write_by_file(lines: DataFrame, path: str, files: DataFrame, position: str = "line", part_bytes: int = PART_BYTES) -> None:
    """A new folder with a file for each of ``files``, named like the input's, lines in ``position`` order."""
    names = [r[0].rsplit("/", 1)[-1] for r in files.select("file").collect()]
    write_files(lines, path, F.element_at(F.split("file", "/"), -1), position, part_bytes=part_bytes, empty=names)


def write_csv(df: DataFrame, path: str, header: bool = False) -> None:
    """Flat columns as CSV, such as the typed fields of structured results."""
    df.write.csv(path, header=header, escape='"')


def write_chunks(df: DataFrame, path: str, extension: str = ".jsonl", part_bytes: int = PART_BYTES) -> None:
    """A new folder with a file for each ``chunk_name``, such as ``stem-001.jsonl``, lines by ``pos``."""
    write_files(df, path, F.concat("chunk_name", F.lit(extension)), "pos", part_bytes=part_bytes)
