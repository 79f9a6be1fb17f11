"""Line de-duplication over overlapping windows of three lines.

Every three consecutive lines are hashed (two independent 64-bit hashes). An empty line is
put before and after each text for that, so first and last lines and texts of one or two
lines have windows too. Hashes found more than once anywhere are joined back to the
windows; each occurrence but the first (by doc_id, text hash, then position) covers its
lines, overlapping covers merge, and covered lines are removed. A removed line always has
an equal line earlier in the order that stays.

Cases. Null text stays null; windows of blank lines only do not count. A text whose lines
are all covered becomes empty. Null ids come after all others. Different texts of one id,
or of null ids, are different places, by the hash of the text; rows equal in id and text
are one place and get equal results. Very long texts are read whole. All columns are kept;
a column `lines_removed` is added, or replaced where there is one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylake.llm.common import staged

WIDTH = 3
BLANK = " \t\r\x0b\x0c"


def windows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, row, pos, h1, h2) of every window with a line that is not blank; window 0 starts
    at the empty line before the text."""
    lines, edge = F.col("lines"), F.array(F.lit(""))

    def hashed(first, pos):
        group = [first] + [F.get(lines, pos + k) for k in range(1, WIDTH)]
        blank = F.lit(True)
        for line in group:
            blank = blank & (F.length(F.btrim(line, F.lit(BLANK))) == 0)
        return F.struct(
            pos.alias("pos"),
            F.when(~blank, F.xxhash64(*group)).alias("h1"),
            F.xxhash64(F.lit(WIDTH), *group).alias("h2"),
        )

    return (
        docs.select(
            F.col(id_col).alias("doc"),
            F.xxhash64(text_col).alias("row"),
            F.concat(edge, F.split(text_col, "\n", -1), edge).alias("lines"),
        )
        .filter(F.col("lines").isNotNull())
        .select(
            "doc",
            "row",
            F.explode(F.transform(F.slice(lines, 1, F.size(lines) - (WIDTH - 1)), hashed)).alias("w"),
        )
        .select("doc", "row", "w.*")
        .filter(F.col("h1").isNotNull())
    )


def later_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, row, starts): the positions of windows that occurred before."""
    every = windows(docs, id_col, text_col)
    place = F.struct(F.col("doc").isNull().alias("none"), "doc", "row")
    repeated = staged(
        every.groupBy("h1", "h2")
        .agg(F.count("*").alias("n"), F.min(place).alias("first"))
        .filter("n > 1")
        .select("h1", "h2", "first"),
        "line-windows",
    )
    found = every.join(repeated, ["h1", "h2"]).select(
        "doc", "row", "h1", "h2", "pos", (place != F.col("first")).alias("later")
    )
    found = found.distinct()  # equal rows are one place
    inside = Window.partitionBy("doc", "row", "h1", "h2").orderBy("pos")
    return (
        found.repartition("doc", "row")
        .withColumn("nth", F.dense_rank().over(inside))
        .filter("later OR nth > 1")
        .groupBy("doc", "row")
        .agg(F.collect_set("pos").alias("starts"))
    )


def remove_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`docs` without the lines of later windows, and how many each row lost."""
    docs = docs.drop("lines_removed")
    later = later_windows(docs, id_col, text_col).select(
        F.col("doc").alias("__doc"), F.col("row").alias("__row"), F.col("starts").alias("__starts")
    )
    marked = docs.join(
        later,
        F.col(id_col).eqNullSafe(F.col("__doc")) & (F.xxhash64(text_col) == F.col("__row")),
        "left",
    ).select(*docs.columns, "__starts")
    at, schema = docs.columns.index(text_col), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, starts = batch.columns
            texts, removed = columns[at].to_pylist(), [0] * batch.num_rows
            for i, found in enumerate(starts.to_pylist()):
                if found:
                    lines = texts[i].split("\n")
                    covered = np.zeros(len(lines) + 2, bool)
                    for k in range(WIDTH):
                        covered[np.array(found) + k] = True
                    covered = covered[1:-1]
                    texts[i] = "\n".join(x for x, c in zip(lines, covered.tolist(), strict=True) if not c)
                    removed[i] = int(covered.sum())
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(removed, pa.int32())], [*schema.names, "lines_removed"]
            )

    lost = T.StructField("lines_removed", T.IntegerType())
    return marked.mapInArrow(run, T.StructType([*schema.fields, lost]))
