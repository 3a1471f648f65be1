"""Helpers shared by the training-data operators."""
from __future__ import annotations

import os
import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from streakflow.llm.word_table import give_back, release
from streakflow.shipping import ship

#: ASCII white space, the class the contracts name (fixed value).
SPACE = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Only a local master (tests)
    may run without one; it then gets a temporary folder of its own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local[") and spark.conf.get("spark.master", "") != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="streakflow-shared-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet under the shared checkpoint folder and read
    back: lineage ends there, and a lost executor costs a reread only. (A written
    table, because ``checkpoint()`` computes its input twice.)"""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/streakflow-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Removes the files of a table that ``cut`` wrote, once nothing will read it again
    (the loops that replace a table by its successor)."""
    spark, own = table.sparkSession, re.compile(r"/streakflow-[0-9a-f]{32}$")
    for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
        if own.search(folder):  # never anything that ``cut`` has not written
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def small_side(df: DataFrame, most_rows: int = 1_000_000) -> DataFrame:
    """A narrow table, written and counted: broadcast up to ``most_rows`` rows (tens of
    bytes each), joined by shuffle beyond."""
    kept = cut(df)
    return F.broadcast(kept) if kept.count() <= most_rows else kept


def map_arrow(df: DataFrame, run, schema, keeps: bool = False) -> DataFrame:
    """``df.mapInArrow`` with this package made available to the workers. Spark's workers
    serve one query after another: unless ``run`` itself uses ``kept`` (``keeps``), what an
    earlier operator kept is dropped first, and every task returns its memory at its end."""
    ship(df.sparkSession)

    def tidy(batches):
        if not keeps:
            release()
        yield from run(batches)
        give_back()

    return df.mapInArrow(tidy, schema)


def text_of(name: str) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def normalised(name: str) -> Column:
    """The whole text with every run of ASCII white space as one space."""
    return F.regexp_replace(text_of(name), SPACE, " ")


def texts(column: pa.ChunkedArray | pa.Array) -> list[str]:
    """Arrow strings as Python strings; bytes that are no UTF-8 become U+FFFD."""
    try:
        values = column.to_pylist()
    except UnicodeDecodeError:
        values = [None if b is None else b.decode("utf-8", "replace") for b in column.cast(pa.binary()).to_pylist()]
    return ["" if v is None else v for v in values]


def by_bytes(batch: pa.RecordBatch, column: int, most: int = 4 << 20):
    """The batch in slices whose texts have about ``most`` bytes (one row at least), so
    that a worker never holds the Python strings of a whole batch."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


class Memo(dict):
    """Results by key, computed for many missing keys at a time. It is emptied when
    it holds ``limit`` entries, so a worker's memory stays bounded whatever the
    vocabulary; that costs recomputation only and never changes a result."""

    def __init__(self, compute, limit: int = 400_000):
        super().__init__()
        self.compute, self.limit = compute, limit

    def learn(self, keys: set) -> None:
        """Makes every one of ``keys`` available (keys of one Arrow batch)."""
        new = [k for k in keys if k not in self]  # a difference of sets would walk the whole memo
        if len(self) + len(new) > self.limit:
            self.clear()
            new = list(keys)
        self.update(zip(new, self.compute(new)))


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; the package or $TOKENIZER_DIR names the folder."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
