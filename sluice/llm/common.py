"""What several operators share: stored tables, held-out rows, bounded samples of labelled rows."""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.folders import Folders
from sluice.functions.shared import fresh_folder

#: One word: characters other than blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


class Lexicon(dict):
    """Numbers for words, given when they are first asked for, and values made once for each.

    ``kinds`` are the type codes of the values that ``make`` gives. Emptied between two texts once it
    holds ``most`` words.
    """

    def __init__(self, make: Callable, kinds: str, most: int = 100_000):
        super().__init__()
        self.make, self.columns, self.most = make, [array(kind) for kind in kinds], most

    def __missing__(self, word) -> int:
        for column, value in zip(self.columns, self.make(word)):
            column.append(value)
        self[word] = number = len(self)
        return number

    def look_up(self, words: list) -> tuple[np.ndarray, list[np.ndarray]]:
        """The numbers of the words of one text, and their values."""
        if len(self) > self.most:
            self.clear()
            self.columns = [array(column.typecode) for column in self.columns]
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if not len(words):
            return numbers, [np.zeros(0, column.typecode) for column in self.columns]
        return numbers, [np.frombuffer(column, column.typecode)[numbers] for column in self.columns]


#: Where the folders of stored tables are noted, in a block that removes them.
_noted: ContextVar[list[str] | None] = ContextVar("noted", default=None)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder (``spark.checkpoint.dir``) and read from there.

    Cuts the lineage: what is computed behind it reads the same rows again after an executor is lost.
    """
    folder = fresh_folder(df.sparkSession)
    if _noted.get() is not None:
        _noted.get().append(folder)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What is stored within the block, by any operator in it, is removed at its end.

    Results that read from it must have been written elsewhere by then.
    """
    folders: list[str] = []
    token = _noted.set(folders)
    try:
        yield
    finally:
        _noted.reset(token)
        for folder in folders:
            Folders(spark).delete(folder)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Stored rows with a number of their own, which tells even repeated rows apart."""
    return stored(df.withColumn(name, F.monotonically_increasing_id()))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores behind it if the table has such a column (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(doc_id: Column) -> Column:
    """Rows that no label may be learnt from; false where the id is NULL."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """At most ``per_class`` documents of each label, as ``doc_id``, ``text``, ``label`` (0 or 1).

    Chosen by a hash of the id, so reruns agree. Held-out rows, NULL ids and ids whose labels
    contradict each other are left out; of documents that share an id that with the last text counts. So that no
    wording counts because it was copied, of documents with one label whose least hash of five words
    is the same one counts, too.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where("doc_id IS NOT NULL AND label IN (0, 1)")
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .drop("other")
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(*order).limit(per_class)
        chosen = part if chosen is None else chosen.unionAll(part)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # Two times per_class ids at most.
    found = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.max("text").alias("text"))
    words = F.split(F.lower("text"), r"[\x20\x09-\x0D]+")
    least = F.array_min(
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.size("words") - 4, F.lit(1))),
            lambda i: F.xxhash64(F.slice("words", i, 5)),
        )
    )
    marked = found.withColumn("words", words).withColumn("least", least).drop("words")
    row = F.max(F.struct("doc_id", "text")).alias("row")
    return marked.groupBy("label", "least").agg(row).select("row.*", "label")


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Stored rows with their place in the order, from 0. Sorted in ranges; only the number of
    rows of each range (as many as there are shuffle partitions) comes to the driver."""
    place = F.monotonically_increasing_id()
    rows = stored(df.orderBy(*order).withColumn(name, place))
    part, within = F.shiftright(name, 33), F.col(name).bitwiseAND((1 << 33) - 1)
    sizes = sorted(map(tuple, rows.groupBy(part.alias("part")).count().collect()))
    if not sizes:
        return rows
    before, pairs = 0, []
    for number, size in sizes:
        pairs += [F.lit(number), F.lit(before).cast("long")]
        before += size
    return rows.withColumn(name, F.element_at(F.create_map(*pairs), part) + within)
