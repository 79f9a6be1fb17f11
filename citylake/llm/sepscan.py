"""Token counts from flat token files by scanning for the end-of-document id.

The files are bare 16-bit little-endian ids without an index. A file is cut into blocks of
equal size; a block is searched for the end id in one vector comparison. Where a document
crosses block edges, a prefix scan over the blocks joins its pieces: the running number of
end ids gives ordinals, the running maximum of the last end gives the start of the open
document. The scan runs in two levels (within runs of blocks, then over the runs), so no
task sees all blocks of a file.

Cases. An empty file, and an empty table, give no rows; two end ids in a row are an empty
document; ids after the last end id are a document that is not `ended`. Null and empty
texts are written as empty documents. Repeated rows are repeated documents. Very long
texts are cut like all others. Other columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citylake.llm.common import staged, text_slices
from citylake.session import shared_dir
from citylake.sources.files import opened

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
END = 50256  # the first id the vocabulary leaves free
BLOCK_TOKENS = 1 << 20
RUN_BLOCKS = 1024
WIDTH = 2


@functools.lru_cache(maxsize=2)
def encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def write_token_files(
    docs: DataFrame, folder: str, path: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One flat file per task under `folder`; (file, ordinal, doc_id) as a written table.

    A retried task writes a new file; only files named in the table count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        coder = encoding(path or public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
        name, ordinal = f"{uuid.uuid4().hex}.bin", 0
        system, root = opened(folder)
        system.create_dir(root)
        with system.open_output_stream(f"{root}/{name}") as out:
            for batch in batches:
                for at, texts in text_slices(batch.column(1)):
                    for text in texts:
                        ids = coder.encode_ordinary(text or "")
                        ids.append(END)
                        out.write(np.array(ids, "<u2").tobytes())
                    size = len(texts)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name] * size),
                            pa.array(np.arange(ordinal, ordinal + size)),
                            batch.column(0).slice(at, size),
                        ],
                        ["file", "ordinal", "doc_id"],
                    )
                    ordinal += size

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return staged(rows.mapInArrow(run, "file string, ordinal long, doc_id long"), "token-manifest")


def scan_block(ids: np.ndarray, end: int) -> tuple[int, list[int]]:
    """Tokens after the last end id, and tokens before each end id since the one before."""
    ends = np.flatnonzero(ids == end)
    if not len(ends):
        return len(ids), []
    return len(ids) - int(ends[-1]) - 1, (np.diff(ends, prepend=-1) - 1).tolist()


def block_scan(spark: SparkSession, folder: str, block_tokens: int, end: int) -> DataFrame:
    """(file, block, n_tokens, tail, counts) of every block of the flat files in `folder`."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder)
    size = block_tokens * WIDTH
    blocks = files.filter("length > 0").select(
        "path",
        "length",
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / size))).alias("block"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, name = opened(row["path"])
                with system.open_input_file(name) as file:
                    data = file.read_at(min(size, row["length"] - row["block"] * size), row["block"] * size)
                ids = np.frombuffer(data, "<u2")
                tail, counts = scan_block(ids, end)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["path"].rsplit("/", 1)[-1]]),
                        pa.array([row["block"]]),
                        pa.array([len(ids)], pa.int64()),
                        pa.array([tail], pa.int64()),
                        pa.array([counts], pa.list_(pa.int64())),
                    ],
                    ["file", "block", "n_tokens", "tail", "counts"],
                )

    schema = "file string, block long, n_tokens long, tail long, counts array<long>"
    return blocks.repartition("path", "block").mapInArrow(run, schema)


def documents_in(
    spark: SparkSession, folder: str, block_tokens: int = BLOCK_TOKENS, end: int = END
) -> DataFrame:
    """(file, ordinal, start, n_tokens, ended) of every document of the flat files."""
    blocks = staged(block_scan(spark, folder, block_tokens, end), "token-blocks").withColumns(
        {
            "run": F.floor(F.col("block") / RUN_BLOCKS),
            "first": F.col("block") * block_tokens,
            "ends": F.size("counts").cast("long"),
        }
    )
    last_end = F.when(F.col("ends") > 0, F.col("first") + F.col("n_tokens") - F.col("tail"))
    blocks = blocks.withColumn("last_end", last_end)
    before = Window.partitionBy("file", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    runs = blocks.groupBy("file", "run").agg(
        F.sum("ends").alias("run_ends"), F.max("last_end").alias("run_last"), F.max("block").alias("run_block")
    )
    earlier = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "file",
        "run",
        F.coalesce(F.sum("run_ends").over(earlier), F.lit(0)).alias("base_ends"),
        F.max("run_last").over(earlier).alias("base_last"),
        (F.max("run_block").over(Window.partitionBy("file")) == F.col("run_block")).alias("last_run"),
    )
    joined = blocks.withColumns(
        {
            "own_ends": F.coalesce(F.sum("ends").over(before), F.lit(0)),
            "own_last": F.max("last_end").over(before),
            "last_block": F.lead("block").over(Window.partitionBy("file", "run").orderBy("block")).isNull(),
        }
    ).join(runs, ["file", "run"])
    opened_at = F.coalesce("own_last", "base_last", F.lit(0))
    pieces = joined.select(
        "file",
        (F.col("base_ends") + F.col("own_ends")).alias("base"),
        opened_at.alias("open"),
        "first",
        "n_tokens",
        "ends",
        "tail",
        (F.col("last_run") & F.col("last_block")).alias("last"),
        F.posexplode_outer("counts").alias("k", "count"),
    )
    start = F.col("first") + F.col("before")
    running = Window.partitionBy("file", "base", "first").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    complete = (
        pieces.filter("k IS NOT NULL")
        .withColumn("before", F.coalesce(F.sum(F.col("count") + 1).over(running), F.lit(0)))
        .select(
            "file",
            (F.col("base") + F.col("k")).alias("ordinal"),
            F.when(F.col("k") == 0, F.col("open")).otherwise(start).alias("start"),
            F.when(F.col("k") == 0, F.col("count") + F.col("first") - F.col("open"))
            .otherwise(F.col("count"))
            .alias("n_tokens"),
            F.lit(True).alias("ended"),
        )
    )
    reached = F.col("first") + F.col("n_tokens")
    tail_start = F.when(F.col("ends") > 0, reached - F.col("tail")).otherwise(F.col("open"))
    open_end = (
        pieces.filter("last AND (k IS NULL OR k = 0)")
        .select(
            "file",
            (F.col("base") + F.col("ends")).alias("ordinal"),
            tail_start.alias("start"),
            (reached - tail_start).alias("n_tokens"),
            F.lit(False).alias("ended"),
        )
        .filter("n_tokens > 0")
    )
    return complete.union(open_end)


def count_tokens(docs: DataFrame, path: str | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, file, ordinal, start, n_tokens): counts read back from the flat files of `docs`."""
    folder = shared_dir(docs.sparkSession, "token-files")
    manifest = write_token_files(docs, folder, path)
    if not manifest.head(1):
        none = F.lit(0).cast("long")
        return manifest.select("doc_id", "file", "ordinal", none.alias("start"), none.alias("n_tokens"))
    found = documents_in(docs.sparkSession, folder, block_tokens)
    return manifest.join(found, ["file", "ordinal"]).select("doc_id", "file", "ordinal", "start", "n_tokens")
