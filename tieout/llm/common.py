"""Small helpers shared by the operators: tables, stored steps, folds, hashes in tasks."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tieout
from tieout.session import scratch_path

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
MIX_2 = np.uint64(0x94D049BB133111EB)


_SHIPPED: set[str] = set()


def found_by_tasks(spark: SparkSession) -> None:
    """Have Spark bring this package to the Python workers, once in an application, wherever
    that was started. Every operator that runs Python in tasks calls this first."""
    context = spark.sparkContext
    root = Path(tieout.__file__).resolve().parent
    if context.applicationId in _SHIPPED or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="run-"), "tieout.zip")  # Spark serves it from here
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    found_by_tasks(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write to the cluster's shared folder and read back: lineage ends here, and what
    follows sees the same rows however often it runs."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, folds: int) -> Column:
    """Remainder of the CRC-32 of the id's text; a null id has none."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def salt(n: int) -> np.uint64:
    """The n-th step of a Weyl sequence, to draw independent numbers from one hash."""
    return np.uint64(n * int(GOLDEN) % 2**64)


class WordHashes(dict):
    """64-bit hash of each distinct word seen by this task; emptied when it gets large."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_hashes(words: list[bytes], n_words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; of the whole sequence if shorter."""
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    size = min(n_words, len(words))
    n = len(w) - size + 1
    grams = np.full(n, size, np.uint64)
    for i in range(size):
        grams = mixed(grams * GOLDEN + w[i : i + n])
    return np.unique(grams)


def ascii_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode("utf-8", "replace").lower().split() if text else []
