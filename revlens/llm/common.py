"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable
from typing import Generic, TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.session import stage_table

K = TypeVar("K", bound=Hashable)
V = TypeVar("V")

#: A table is sent to every executor only if it has been counted and stays below this size.
BROADCAST_BYTES = 64 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the folder all executors share and read back."""
    return stage_table(df, f"llm-{name}")


def send_if_small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """``df`` marked for broadcast if its counted size allows it, else as it is, for a shuffled join."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def fold(doc_id: Column | str) -> Column:
    """0 to 4; rows of fold 0 are held out from every fit. A NULL id counts as the empty text."""
    text = F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit(None))
    return F.pmod(F.crc32(F.coalesce(text.cast("string"), F.lit("")).cast("binary")), F.lit(5))


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    rows: int,
    split_from: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "label",
) -> DataFrame:
    """``id``, ``text``, ``label``, ``half`` of labelled rows that are not held out, written aside.

    If there are more than ``rows``, a hash of the id thins them to about that many; a fit's cost is
    bounded thus. ``half`` is 0 or 1, or -1 for all where there are fewer than ``split_from``. Labels
    other than 0 and 1, and NULL ids, are no labels; of several labels of an id the largest counts.
    """
    marks = (
        labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
        .where("id is not null and label in (0, 1)")
        .where(fold("id") != 0)
        .groupBy("id")
        .agg(F.max("label").alias("label"))
    )
    marks = staged(marks, "fit-labels")
    total = marks.count()
    if total > rows:
        share = int(rows / total * 1_000_000)
        marks = marks.where(F.pmod(F.xxhash64("id", F.lit("fit")), F.lit(1_000_000)) < share)
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    named = named.join(F.broadcast(marks), "id")  # about ``rows`` rows of two numbers
    half = F.pmod(F.xxhash64("id", F.lit("half")), F.lit(2)) if total >= split_from else F.lit(-1)
    return staged(named.withColumn("half", half.cast("int")), "fit-texts")


def spare_name(df: DataFrame, base: str) -> str:
    """A column name ``df`` does not have, however its own are spelled."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


class Memo(dict, Generic[K, V]):
    """A bounded memory of ``make(key)``: keys in recent use stay, all others are made anew when needed.

    Two generations of at most ``limit`` entries. ``memo[key]`` costs one lookup for keys of the
    younger one, so it can be mapped over long lists.
    """

    def __init__(
        self, make: Callable[[K], V], limit: int = 150_000, make_many: Callable[[list[K]], list[V]] | None = None
    ):
        super().__init__()
        self._make = make
        self._make_many = make_many
        self._limit = limit
        self._old: dict[K, V] = {}

    def __missing__(self, key: K) -> V:
        value = self._old.get(key)
        if value is None:
            value = self._make(key)
        if len(self) >= self._limit:
            self._old = dict(self)
            self.clear()
        self[key] = value
        return value

    def many(self, keys: Iterable[K]) -> list[V]:
        """The values of all keys; what is missing is made in one call where ``make_many`` is given."""
        if self._make_many is None:
            return list(map(self.__getitem__, keys))
        keys = list(keys)
        found = list(map(self.get, keys))
        missing = [k for k, v in zip(keys, found) if v is None]
        if not missing:
            return found
        older = list(map(self._old.get, missing))
        unknown = [k for k, v in zip(missing, older) if v is None]
        fresh = {k: v for k, v in zip(missing, older) if v is not None}
        fresh.update(zip(unknown, self._make_many(unknown)))
        if len(self) + len(fresh) > self._limit:
            self._old = dict(self)
            self.clear()
        self.update(fresh)
        return [fresh[k] if v is None else v for k, v in zip(keys, found)]
