"""Reading the tables, the shared folder, and Arrow maps."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Source tables of records: key and text expressions. Fixed names of the tables.
RECORD_TABLES = {
    "conv_sentences": ("title_key", "translation.el"),
    "lit_sentences": ("work_key", "translation.el"),
    "wiki_articles": ("page_key", "text"),
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str, names=tuple(RECORD_TABLES)) -> DataFrame:
    """rec_id, source_name, split_name, lang, text of the named tables, redelivered rows included."""
    parts = [
        load(spark, sf_dir, n).select("rec_id", F.lit(n).alias("source_name"), "split_name", "lang", F.col(RECORD_TABLES[n][1]).alias("text"))
        for n in names
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir; a temporary one only where that is unset on one machine."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not base:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="logosmill-")
        atexit.register(shutil.rmtree, base, True)
        spark.conf.set("spark.checkpoint.dir", base)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_value(path: str, column: str, **key: int) -> bytes | None:
    """On an executor: the one value of a table in the shared folder whose key columns have these values; None if there is none."""
    import pyarrow.dataset as pads
    from pyarrow import fs

    f, where = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    test = None
    for k, v in key.items():
        test = (pads.field(k) == v) if test is None else test & (pads.field(k) == v)
    t = pads.dataset(where, filesystem=f, format="parquet").to_table(columns=[column], filter=test)
    return t.column(column)[0].as_py() if t.num_rows else None


def hash_sample(df: DataFrame, id_col: str, size: int) -> DataFrame:
    """About ``size`` rows (all, if there are no more), those whose id has the least hashes. Only these rows leave the executors."""
    total = df.count()
    if total <= size:
        return df
    bound = int(size / total * (1 << 63))
    return df.where(F.expr(f"shiftrightunsigned(xxhash64(`{id_col}`), 1) < {bound}L"))
