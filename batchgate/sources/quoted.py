"""Records of CSV files whose quoted fields have line breaks, in a scan that splits.

Whether a line begins inside a quoted field depends on everything before it, so every
line is taken as a function: is a field open after it, if none was before it, and
if one was? Functions of the lines of a split are composed, those of the splits of
a file as well (a prefix scan over splits, which are few), and with the state at
each line known, lines are put together to records, across lines and splits.

Pieces of a field are joined without the break between them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchgate.operators.lookups import lookup
from batchgate.session import Table, materialise, release

# A field over so many characters makes its file unreadable; longer records are not put together.
FIELD_LIMIT = 131_072
RECORD_LIMIT = 16 * FIELD_LIMIT

# A whole quoted field where a field begins.
_QUOTED = r'(?<=^|,)"(?:[^"]++|"")*+"'


def opens(line: Column) -> Column:
    """Is a quoted field open after ``line``, if none is before it?

    A quote opens a field only where the field begins; elsewhere it is text.
    """
    bare = F.regexp_replace(line, _QUOTED, "")
    return F.when(line.contains('"'), bare.rlike('(?:^|,)"')).otherwise(F.lit(False))


def stays_open(line: Column) -> Column:
    """Is a quoted field open after ``line``, if one is before it?"""
    return F.when(line.contains('"'), opens(F.concat(F.lit('"'), line))).otherwise(F.lit(True))


def _after(window, fixed: Column, value: Column, flips: Column) -> dict[str, Column]:
    """Columns that compose the functions of an ordered window, to be added one by one.

    A function has a ``fixed`` result ``value``, or flips the state, or leaves it. ``known``
    tells whether the composed one is fixed; ``state`` is its result, for state 0 if not.
    """
    turned, last = F.col("turned"), F.col("last")
    seen = F.when(fixed, F.struct(value.alias("v"), turned.alias("at")))
    odd = F.pmod(turned - F.coalesce(last["at"], F.lit(0)), F.lit(2)) == 1
    return {
        "turned": F.sum(F.when(~fixed & flips, 1).otherwise(0)).over(window),
        "last": F.last(seen, True).over(window),
        "known": last.isNotNull(),
        "state": F.coalesce(last["v"], F.lit(False)) != odd,
    }


def _composed(df: DataFrame, window, fixed: Column, value: Column, flips: Column) -> DataFrame:
    for name, column in _after(window, fixed, value, flips).items():
        df = df.withColumn(name, column)
    return df


_SPLIT = ["source_key", "block"]


def _within():
    return Window.partitionBy(*_SPLIT).orderBy("row_seq")


def _so_far():
    return _within().rowsBetween(Window.unboundedPreceding, 0)


def _placed(lines: DataFrame) -> DataFrame:
    """Add ``known`` and ``state`` after each line, from the lines of its split."""
    none = F.col("after_none")
    return _composed(lines, _so_far(), none == F.col("after_open"), none, none)


def _starting(placed: DataFrame) -> DataFrame:
    """Add ``start``, the row_seq of lines that begin a record, and ``record``, the latest of the split.

    ``begin`` tells whether a field is open where the split begins.
    """
    is_open = F.when(F.col("known"), F.col("state")).otherwise(F.col("state") != F.col("begin"))
    placed = placed.withColumn("is_open", is_open)
    starts = ~F.coalesce(F.lag("is_open").over(_within()), F.col("begin"))
    started = placed.withColumn("start", F.when(starts, F.col("row_seq")))
    return started.withColumn("record", F.last("start", True).over(_so_far()))


def put_together(lines: DataFrame) -> tuple[Table, Table, Table]:
    """Records (source_key, row_seq, value), those of them in several splits, and files with overlong ones.

    ``lines`` has source_key, block (where the split begins), row_seq, which orders the lines
    of a file, and value. A record has the ``row_seq`` of its first line.

    What lies where is found without the text. The text is then shuffled by split, once;
    the pieces of a record that several splits hold are few, and only they are shuffled again.
    """
    spark = lines.sparkSession
    turned = lines.withColumns(
        {
            "after_none": opens(F.col("value")),
            "after_open": stays_open(F.col("value")),
            "length": F.length("value"),
        }
    )
    staged = materialise(turned, "quoted-lines")
    bare = staged.df.select(*_SPLIT, "row_seq", "after_none", "after_open", "length")
    placed = materialise(_placed(bare).select(*_SPLIT, "row_seq", "length", "known", "state"), "quoted-states")

    # Splits of a file in order: what is open where each begins.
    splits = placed.df.groupBy(*_SPLIT).agg(F.max_by(F.struct("known", "state"), "row_seq").alias("f"))
    order = Window.partitionBy("source_key").orderBy("block")
    here = order.rowsBetween(Window.unboundedPreceding, 0)
    scanned = _composed(splits, here, F.col("f.known"), F.col("f.state"), F.col("f.state"))
    begun = scanned.select(*_SPLIT, F.coalesce(F.lag("state").over(order), F.lit(False)).alias("begin"))
    marked = materialise(
        _starting(placed.df.join(begun, _SPLIT)).select(*_SPLIT, "length", "begin", "start", "record"),
        "quoted-marks",
    )
    # A record that began in an earlier split.
    latest = (
        marked.df.groupBy(*_SPLIT).agg(F.max("start").alias("start"), F.first("begin").alias("begin"))
        .withColumn("earlier", F.last("start", True).over(order.rowsBetween(Window.unboundedPreceding, -1)))
        .select(*_SPLIT, "begin", "earlier")
    )
    entered = materialise(latest, "quoted-splits")
    lengths = (
        marked.df.join(entered.df.select(*_SPLIT, "earlier"), _SPLIT)
        .groupBy("source_key", F.coalesce("record", "earlier").alias("record"))
        .agg(
            F.sum("length").alias("length"),
            F.count(F.lit(1)).alias("lines"),
            (F.min("block") != F.max("block")).alias("spans"),
        )
    )
    # Lines of overlong records are never gathered.
    over = (F.col("lines") > 1) & (F.col("length") > RECORD_LIMIT)
    special = materialise(
        lengths.select("source_key", "record", "lines", "spans", over.alias("over")).where("spans OR over"),
        "quoted-special",
        F.octet_length("source_key"),
    )
    text = _starting(_placed(staged.df).join(entered.df, _SPLIT)).select(
        *_SPLIT, F.coalesce("record", "earlier").alias("record"), "row_seq", "value"
    )
    key = {"record": F.col("record"), "source_key": F.col("source_key")}
    told = lookup(text, special, key, ["spans", "over"], "lines", F.col("row_seq"))
    told = told.where(~F.coalesce("over", F.lit(False)))

    def gathered(df: DataFrame, *by: str) -> DataFrame:
        in_order = F.array_sort(F.collect_list(F.struct("row_seq", "value")))
        joined = F.array_join(F.transform(in_order, lambda p: p["value"]), "")
        return df.groupBy("source_key", *by).agg(joined.alias("value"))

    # A split's lines are together already, so its pieces take no other shuffle.
    split = told.withColumn("whole", ~F.coalesce("spans", F.lit(False)))
    pieces = materialise(
        gathered(split, "block", "record", "whole").select(
            "source_key", "block", F.col("record").alias("row_seq"), "value", "whole"
        ),
        "records",
    )
    parts = pieces.df.where(~F.col("whole")).select(
        "source_key", F.col("row_seq").alias("record"), F.col("block").alias("row_seq"), "value"
    )
    spanning = materialise(
        gathered(parts, "record").select("source_key", F.col("record").alias("row_seq"), "value"), "spanning"
    )
    whole = pieces.df.where("whole").select("source_key", "row_seq", "value")
    overlong = materialise(
        special.df.where("over").select("source_key").distinct(), "overlong", F.octet_length("source_key")
    )
    release(spark, staged.path, placed.path, marked.path, entered.path, special.path)
    records = Table(whole.unionByName(spanning.df), pieces.rows + spanning.rows, 0, pieces.path, {})
    return records, spanning, overlong


@dataclass(frozen=True)
class Records:
    """Records of files with quoted line breaks.

    ``files``: (source_key, n_lines); ``headers``: (source_key, first, header, n_lines), of
    which ``first`` is the header's row_seq; ``overlong``: files with a record over the limit.
    ``table`` includes ``spanning``, the records of several splits.
    """

    table: Table
    files: Table
    headers: Table
    overlong: Table
    spanning: Table

    @property
    def paths(self) -> list[str]:
        return [t.path for t in (self.table, self.files, self.headers, self.overlong, self.spanning)]


def find_records(lines: DataFrame, files: Table) -> Records:
    """Records of the ``lines`` of ``files``."""
    table, spanning, overlong = put_together(lines)
    width = F.octet_length("source_key")
    # Where a file begins is found without the text, which an aggregation would sort.
    firsts = materialise(
        table.df.groupBy("source_key").agg(F.min("row_seq").alias("first")).join(files.df, "source_key"),
        "record-firsts",
        width,
    )
    key = {"first": F.col("row_seq"), "source_key": F.col("source_key")}
    found = lookup(table.df, firsts, key, ["n_lines"], "n_lines", F.col("row_seq"))
    headers = materialise(
        found.where(F.col("n_lines").isNotNull()).select(
            "source_key", F.col("row_seq").alias("first"), F.col("value").alias("header"), "n_lines"
        ),
        "record-headers",
        width,
    )
    release(files.df.sparkSession, firsts.path)
    return Records(table, files, headers, overlong, spanning)
