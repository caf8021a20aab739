"""Small pieces that several operators of this package share."""

from __future__ import annotations

import ctypes
import gc
import string
from collections.abc import Callable
from sys import getsizeof

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.session import prefer

#: A word of the token-free operators: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes that an entry of a dictionary takes beside its key and value.
SLOT = 104


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of one of the given tables."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def ascii_lower(text: Column | str) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


_HOLDERS: dict[str, Callable[[], None]] = {}


def hold_alone(name: str, clear: Callable[[], None]) -> None:
    """A Python worker serves many stages: what other operators remember there is dropped, and ``clear``
    will drop what the caller is about to remember."""
    hold_nothing(name)
    _HOLDERS[name] = clear


def hold_nothing(but: str = "") -> None:
    """Drop what operators remember in this worker, and give the memory back to the system."""
    for other in [k for k in _HOLDERS if k != but]:
        _HOLDERS.pop(other)()
    give_back()


def give_back() -> None:
    """Return freed memory to the system, which the C library else keeps for later stages of this worker."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only the GNU library has it
    if trim:
        trim(0)


def small_batches(spark: SparkSession) -> None:
    """Texts go to the Python workers in batches of about 4 MB unless the session has its own limit: Spark and
    the worker both hold a batch, beside the one that is being made."""
    prefer(spark, "spark.sql.execution.arrow.maxBytesPerBatch", "4m")


class Memo(dict):
    """A function's results by argument, in two generations of about ``room`` bytes each: it saves work only.

    When the young generation is full it becomes the old one, whose entries come back when they are asked for
    again; so common arguments stay and rare ones go. Arguments longer than ``longest`` are computed each time."""

    def __init__(self, fn: Callable, room: int, longest: int = 64):
        super().__init__()
        self.fn, self.room, self.longest = fn, room, longest
        self.old: dict = {}
        self.held = 0

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.fn(key)
        if len(key) <= self.longest:
            self.held += getsizeof(key) + getsizeof(value) + SLOT
            if self.held > self.room:
                self.old = dict(self)
                self.clear()
                self.held = getsizeof(key) + getsizeof(value) + SLOT
            self[key] = value
        return value
