"""Files of one JSON array each, read by many tasks.

Spark reads such a file whole in one task, or cuts it at any line.  A line of JSON never
begins inside a string, and in a file written with one indentation a record begins where a
brace stands at the record's depth.  So each task builds the records of its block of lines,
and only the two fragments at a block's borders meet again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from newsignal.sources.articles import CORRUPT, NEWS_FILES, WITH_CORRUPT

FRAGMENT = "file string, block long, part int, body string"
HEAD, WHOLE, TAIL = 0, 1, 2  # lines before a block's first record, a record, the last one
# Of the files that a task reads, whatever the size of their blocks; a file counts as so many more, as in Spark.
TASK_BYTES, OPEN_BYTES = 16 << 20, 4 << 20


def worth(scan: DataFrame) -> int:
    """The tasks that the files of a scan are worth, one per core at least."""
    relation = scan._jdf
    size = int(relation.queryExecution().optimizedPlan().stats().sizeInBytes())
    size += OPEN_BYTES * len(relation.inputFiles())
    return max(scan.sparkSession.sparkContext.defaultParallelism, 1 + size // TASK_BYTES)


def fragments(lines: DataFrame, indent: int) -> DataFrame:
    """Records and border fragments of blocks of lines (file, block, value), in their order."""
    start = re.compile(rf"\[?[ \t]{{0,{indent}}}\{{")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        place, held, begun = None, [], False

        def flush(last: bool) -> None:
            if held:
                out.append((*place, (TAIL if last else WHOLE) if begun else HEAD, "\n".join(held)))
                held.clear()

        def rows() -> pa.RecordBatch:
            columns = list(zip(*out)) or [[]] * 4
            types = [pa.string(), pa.int64(), pa.int32(), pa.string()]
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["file", "block", "part", "body"]
            )

        for batch in batches:
            # numpy makes Python values of a column several times as fast as pyarrow.
            files = batch.column("file").dictionary_encode()
            names = files.dictionary.to_pylist()
            columns = files.indices, batch.column("block"), batch.column("value")
            for file, block, line in zip(*[c.to_numpy(zero_copy_only=False).tolist() for c in columns]):
                if (names[file], block) != place:
                    flush(True)
                    place, begun = (names[file], block), False
                if start.match(line):
                    flush(False)
                    begun = True
                elif line.rstrip() in ("", "[", "]"):  # borders of the array itself
                    continue
                held.append(line)
            yield rows()
        flush(True)
        yield rows()

    return lines.select("file", "block", "value").mapInArrow(cut, FRAGMENT)


def joined_fragments(parts: DataFrame) -> DataFrame:
    """The records that cross borders: a block's last record and the heads of the blocks behind it.

    Windows hold one row per block of a file, never its records.  Both uses of the borders have
    the same columns and filters (none of these is ever null), so Spark runs one scan and shuffle.
    """
    known = F.col("file").isNotNull() & F.col("block").isNotNull() & F.col("body").isNotNull()
    borders = parts.filter((F.col("part") != WHOLE) & known).repartition("file", "block")
    begins = (F.col("part") == TAIL) & F.col("body").isNotNull()
    blocks = borders.groupBy("file", "block").agg(F.bool_or(begins).alias("begins"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    owner = F.last(F.when(F.col("begins"), F.col("block")), ignorenulls=True).over(before)
    owners = blocks.select("file", "block", owner.alias("before"))
    placed = borders.join(owners, ["file", "block"]).withColumn(
        "owner", F.when(F.col("part") == TAIL, F.col("block")).otherwise(F.coalesce("before", F.lit(-1)))
    )
    pieces = F.sort_array(F.collect_list(F.struct("block", "part", "body")))
    return placed.groupBy("file", "owner").agg(F.array_join(F.transform(pieces, lambda p: p["body"]), "\n").alias("body"))


def read_array_files(
    spark: SparkSession, paths: str | list[str], pattern: str = NEWS_FILES, indent: int = 2,
    schema: T.StructType = WITH_CORRUPT,
) -> DataFrame:
    """Records of files that hold one JSON array each, with ``_file``; large files are split.

    A record begins on a line of its own, at most ``indent`` blanks from the margin.  One
    that cannot be parsed keeps its text in ``_corrupt_record`` and spoils no other.  An
    array on one line is read as a whole.  The files are scanned twice, for the records
    within blocks and for those that cross their borders.  A task reads as many blocks as
    it is worth, since starting one takes longer than reading a small block.
    """
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(paths)
    lines = text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )
    parts = fragments(lines.coalesce(worth(text)), indent)
    whole = parts.filter(F.col("part") == WHOLE).select("file", "body")
    records = whole.unionByName(joined_fragments(parts).select("file", "body")).withColumn(
        "body", F.regexp_replace(F.trim(F.col("body")), r",\s*$", "")
    )
    plain = T.StructType([f for f in schema if f.name != CORRUPT])
    array = F.when(F.endswith("body", F.lit("]")), F.col("body")).otherwise(F.concat("body", F.lit("]")))
    many = F.startswith("body", F.lit("["))
    one = F.array(F.from_json("body", schema, {"columnNameOfCorruptRecord": CORRUPT}))
    several = F.transform(
        F.from_json(array, T.ArrayType(plain)),
        lambda r: F.struct(*[r[f.name].alias(f.name) if f.name != CORRUPT else F.lit(None).cast("string").alias(CORRUPT) for f in schema]),
    )
    broken = F.array(F.struct(*[
        (F.col("body") if f.name == CORRUPT else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema
    ]))
    parsed = F.when(many, F.coalesce(several, broken)).otherwise(one)
    return records.select(F.explode(parsed).alias("r"), F.col("file").alias("_file")).select("r.*", "_file")
