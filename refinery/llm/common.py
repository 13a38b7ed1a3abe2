"""Small helpers the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are what stands between these six characters: space and \x09 to \x0D.
ASCII_SPACE = r"[\x20\x09-\x0D]"

#: Entries a worker keeps of what it has worked out for single words.
MEMO_ENTRIES = 300_000
#: Bytes a memo of words may take, of which a word takes so many besides its letters and its
#: value; and the longest word that is kept.
MEMO_BYTES, ENTRY_BYTES, LONGEST = 64 << 20, 160, 64


class Memo(dict):
    """A function of single words, kept for the words met lately.

    When full it starts anew: frequent words are back within a batch, and the memory of
    a worker stays bounded however many different words the corpus has.
    """

    def __init__(self, work: Callable, entries: int = MEMO_ENTRIES):
        super().__init__()
        self.work = work
        self.entries = entries

    def __missing__(self, word):
        found = self.work(word)
        if len(self) >= self.entries:
            self.clear()
        self[word] = found
        return found


class WordMemo(dict):
    """A function of single words, kept for short words up to a number of bytes.

    Words beyond ``LONGEST`` characters, such as whole texts without spaces, are worked out
    anew each time: they hardly come again, and would fill the memory. Half of the bytes are
    for the words met lately, the other half for those before them: when the first half is
    full it takes the place of the second, so that only what was not met for as long is
    forgotten.
    """

    def __init__(self, work: Callable, size: Callable[[object], int], budget: int = MEMO_BYTES):
        super().__init__()
        self.work, self.size = work, size
        self.budget = self.room = budget // 2
        self.older: dict = {}

    def __missing__(self, word):
        found = self.older.get(word)
        if found is None:
            found = self.work(word)
        if len(word) <= LONGEST:
            need = ENTRY_BYTES + 4 * len(word) + self.size(found)
            if need > self.room:
                self.older = self.copy()
                self.clear()
                self.room = self.budget
            self.room -= need
            self[word] = found
        return found


def reach_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did.

    Enough for a local session started elsewhere than in the repository; on a cluster the
    package is installed, or given with ``--py-files``.
    """
    home = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if home not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{known}:{home}".strip(":")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder ``sf_dir``, for operators whose tasks run this package's code."""
    reach_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Where the installed vocabulary ``name`` lies, on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


def shared_bytes(spark: SparkSession, path: str, bound: int = 64 << 20):
    """The content of a vocabulary file for all tasks; executors need no copy of the file."""
    size = Path(path).stat().st_size
    if size > bound:
        raise ValueError(f"{path} has {size} bytes, more than the {bound} that are sent to tasks")
    return spark.sparkContext.broadcast(Path(path).read_bytes())


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; null ids have fold null."""
    return F.crc32(F.col(doc_id).cast("string")) % modulus
