"""CSV files as all-text rows, with the file and position each came from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchgate import schema as S
from batchgate.operators.gate import FILENAME_PATTERN, too_large
from batchgate.operators.lookups import lookup
from batchgate.session import Table, materialise, release
from batchgate.sources.incoming import relative_key
from batchgate.sources.quoted import FIELD_LIMIT, Records, find_records, opens

CSV_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
_CORRUPT = "__raw_line"

# row_seq = file offset of the split, in 4 KiB units, over 28 bits of row index.
_INDEX_BITS = 28
_OFFSET_UNIT_BITS = 12


def row_sequence(block_start: Column) -> Column:
    """A number that orders the rows of a file, whichever split each is in."""
    index = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    return F.shiftleft(F.shiftright(block_start, _OFFSET_UNIT_BITS), _INDEX_BITS) + index


def _paths(root: str, prefix: str, keys: list[str] | None) -> list[str]:
    base = root.rstrip("/")
    return [f"{base}/{prefix}"] if keys is None else [f"{base}/{k}" for k in keys]


def _readable(max_bytes: int) -> Column:
    """File gate over file metadata: files that fail it are dropped at listing.

    Spark evaluates it for every row once more, hence one cheap pattern here;
    the few files with a conventional name but no real date are left out later.
    """
    name = F.col("_metadata.file_name")
    return ~too_large(F.col("_metadata.file_size"), max_bytes) & name.rlike(FILENAME_PATTERN)


def _reader(spark: SparkSession, **options):
    return spark.read.options(
        pathGlobFilter="*.csv", recursiveFileLookup="true", **CSV_OPTIONS, **options
    )


def _lines(
    spark: SparkSession, root: str, max_bytes: int, prefix: str, keys: list[str] | None
) -> DataFrame:
    """Raw lines; ``n`` orders those of one split, ``leads`` marks the first split."""
    lines = _reader(spark).text(_paths(root, prefix, keys)).where(_readable(max_bytes))
    return lines.select(
        "value",
        relative_key(spark, root).alias("source_key"),
        (F.col("_metadata.file_block_start") == 0).alias("leads"),
        F.monotonically_increasing_id().alias("n"),
        F.col("_metadata.file_block_start").alias("block"),
        row_sequence(F.col("_metadata.file_block_start")).alias("row_seq"),
    )


def profile_files(
    spark: SparkSession,
    root: str,
    max_bytes: int = S.MAX_FILE_BYTES,
    prefix: str = S.INCOMING_PREFIX,
    keys: list[str] | None = None,
    columns: list[str] = S.TRANSACTION_COLUMNS,
) -> DataFrame:
    """(source_key, utf8_ok, usual_header, header, n_lines, quoted_breaks) per file, from its raw lines.

    ``header`` is the first line of files whose header is not simply ``columns``.
    ``quoted_breaks``: a line leaves a quoted field open, so lines are not records.

    The text source keeps bytes as they are, so an undecodable line shows up
    here; the CSV source would replace it silently. The scan is splittable,
    each task sends on one record per file, and of its text a header at most.
    """
    first = F.when(F.col("leads"), F.col("n"))
    usual = F.col("value") == ",".join(columns)
    return (
        _lines(spark, root, max_bytes, prefix, keys)
        .groupBy("source_key")
        .agg(
            F.bool_and(F.is_valid_utf8("value")).alias("utf8_ok"),
            F.min_by(usual, first).alias("usual_header"),
            F.min_by(F.when(~usual, F.col("value")), first).alias("header"),
            F.count(F.lit(1)).alias("n_lines"),
            F.bool_or(opens(F.col("value"))).alias("quoted_breaks"),
        )
    )


def read_records(
    spark: SparkSession,
    root: str,
    profile: DataFrame,
    max_bytes: int = S.MAX_FILE_BYTES,
    prefix: str = S.INCOMING_PREFIX,
    keys: list[str] | None = None,
) -> Records | None:
    """Records of the files with line breaks in quoted fields; None if there is no such file."""
    broken = materialise(
        profile.where("utf8_ok AND quoted_breaks").select("source_key", "n_lines", F.lit(True).alias("broken")),
        "broken",
        F.octet_length("source_key"),
    )
    if not broken.rows:
        release(spark, broken.path)
        return None
    lines = _lines(spark, root, max_bytes, prefix, keys)
    key = {"source_key": F.col("source_key")}
    lines = lookup(lines, broken, key, ["broken"], "n_lines", F.col("n")).where("broken")
    return find_records(lines.select("source_key", "block", "row_seq", "value"), broken)


def utf8_gate(profile: DataFrame) -> DataFrame:
    """Files with an undecodable line: rejected whole."""
    return profile.where(~F.col("utf8_ok")).select("source_key")


@dataclass(frozen=True)
class Layouts:
    """Where each column sits in each file.

    ``table`` has only the files whose columns are not in the usual order;
    ``width`` is the number of leading fields any file needs.
    """

    table: Table
    width: int


def column_layouts(profile: DataFrame, columns: list[str], widest: int) -> DataFrame:
    """Add ``layout``: per column its field index, -1 where the file lacks it.

    ``widest`` is the largest number of fields in any header.
    """
    fields = [f"h{i}" for i in range(widest)]
    header = F.from_csv("header", ",".join(f"{f} string" for f in fields), dict(CSV_OPTIONS))
    named = profile.withColumn("__h", header)
    # A repeated name means its last field, hence the reversed search.
    backwards = F.array(*[F.col(f"__h.{f}") for f in reversed(fields)])
    found = [F.coalesce(F.array_position(F.col("__b"), c), F.lit(0)) for c in columns]
    layout = F.array(
        *[F.when(p > 0, F.lit(widest) - p).otherwise(F.lit(-1)).cast("int") for p in found]
    )
    return named.withColumn("__b", backwards).withColumn("layout", layout).drop("__h", "__b")


def find_layouts(
    spark: SparkSession,
    profile: DataFrame,
    columns: list[str] = S.TRANSACTION_COLUMNS,
    records: Records | None = None,
) -> Layouts:
    """Layouts of the files whose header is not simply ``columns``.

    Headers of files in ``records`` are records themselves.
    """
    width = F.octet_length("source_key")
    shape = ["source_key", "header", "n_lines"]
    unusual = profile.where(~F.col("usual_header")).select(*shape)
    if records:
        unusual = unusual.join(records.files.df.select("source_key"), "source_key", "left_anti")
        own = records.headers.df.where(F.col("header") != ",".join(columns))
        unusual = unusual.unionByName(own.select(*shape))
    headers = materialise(
        unusual, "headers", metrics={"widest": F.max(F.size(F.split("header", ",")))}
    )
    if not headers.rows:
        release(spark, headers.path)
        none = spark.createDataFrame([], "source_key string, layout array<int>, n_lines bigint")
        return Layouts(Table(none, 0, 0, "", {}), len(columns))
    laid_out = column_layouts(headers.df, columns, headers.metrics["widest"])
    table = materialise(
        laid_out.select("source_key", "layout", "n_lines"),
        "layouts",
        width + F.lit(4 * len(columns)),
        {"last": F.max(F.array_max("layout"))},
    )
    release(spark, headers.path)
    return Layouts(table, max(len(columns), (table.metrics["last"] or 0) + 1))


def _fields_in(line: Column) -> Column:
    """Number of fields of a raw line; commas inside quoted fields do not count.

    The quantifiers are possessive: Java matches them in a loop, without a stack
    that grows with the length of the field.
    """
    bare = F.regexp_replace(line, r'(?<=^|,)"(?:[^"]++|"")*+"', "")
    return F.size(F.split(bare, ","))


def _record_fields(records: Records, schema: T.StructType) -> DataFrame:
    """Records but the headers, parsed like lines; blank ones are no records."""
    key = {"source_key": F.col("source_key")}
    rows = lookup(records.table.df, records.headers, key, ["first"], "n_lines", F.col("row_seq"))
    options = {**CSV_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    ddl = ", ".join(f"`{f.name}` string" for f in schema.fields)
    blank = F.trim("value") == ""
    return rows.where((F.col("row_seq") > F.col("first")) & ~blank).select(
        F.from_csv("value", ddl, options).alias("f"), "source_key", "row_seq"
    ).select("f.*", "source_key", "row_seq")


def overlong_files(records: Records) -> DataFrame:
    """(source_key): files with a field beyond the limit, which no reader accepts."""
    # Shorter records hold no longer field.
    long = records.table.df.where(F.length("value") > FIELD_LIMIT).select(
        "source_key", F.explode(F.regexp_extract_all("value", F.lit(r'(?<=^|,)("(?:[^"]++|"")*+"|[^,]*+)'), 1)).alias("field")
    ).where(F.length("field") > FIELD_LIMIT + 2).select("source_key")
    return long.union(records.overlong.df).distinct()


def read_batch_csv(
    spark: SparkSession,
    root: str,
    layouts: Layouts | None = None,
    max_bytes: int = S.MAX_FILE_BYTES,
    prefix: str = S.INCOMING_PREFIX,
    keys: list[str] | None = None,
    columns: list[str] = S.TRANSACTION_COLUMNS,
    multi_line: bool = False,
    records: Records | None = None,
) -> DataFrame:
    """``columns`` as text, plus ``source_key`` and ``row_seq``.

    Columns are matched by each file's own header. Within a row an empty field
    is ``''`` and a field the row is too short for is null. Files that fail the
    name or size gate are not opened. Files with line breaks inside quoted fields
    are read from ``records`` (breaks are dropped, joining the pieces);
    ``multi_line`` reads all files that way, at the price of one task per file.
    """
    width = layouts.width if layouts else len(columns)
    names = [columns[i] if i < len(columns) else f"__f{i}" for i in range(width)]
    read_schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _CORRUPT]])
    raw = (
        _reader(
            spark,
            header="true",
            mode="PERMISSIVE",
            columnNameOfCorruptRecord=_CORRUPT,
            multiLine=str(multi_line).lower(),
        )
        .schema(read_schema)
        .csv(_paths(root, prefix, keys))
        .where(_readable(max_bytes))
    )
    positioned = raw.select(
        *names,
        _CORRUPT,
        relative_key(spark, root).alias("source_key"),
        row_sequence(F.col("_metadata.file_block_start")).alias("row_seq"),
    )
    if records:
        key = {"source_key": F.col("source_key")}
        marked = lookup(positioned, records.files, key, ["broken"], "n_lines", F.col("row_seq"))
        whole = marked.where(F.col("broken").isNull()).drop("broken")
        positioned = whole.unionByName(_record_fields(records, read_schema))
    # The raw line is only there when the number of fields is not as expected.
    held = F.when(F.col(_CORRUPT).isNull(), F.lit(width)).otherwise(_fields_in(F.col(_CORRUPT)))
    positioned = positioned.withColumn("__held", held)

    def field_value(i: int) -> Column:
        text = F.col(names[i])
        if multi_line:
            text = F.regexp_replace(text, r"\r\n|\r|\n", "")
        return F.when(F.col("__held") > i, F.coalesce(text, F.lit("")))

    values = [field_value(i) for i in range(width)]
    if layouts is None or layouts.table.rows == 0:
        mapped = dict(zip(columns, values))
    else:
        positioned = lookup(
            positioned,
            layouts.table,
            {"source_key": F.col("source_key")},
            ["layout"],
            "n_lines",
            F.col("row_seq"),
        )
        every = F.array(*values)
        at = [F.get(every, F.col("layout")[i]) for i in range(len(columns))]
        mapped = {
            c: F.when(F.col("layout").isNull(), values[i]).otherwise(at[i])
            for i, c in enumerate(columns)
        }
    return positioned.select(
        *[mapped[c].alias(c) for c in columns], "source_key", "row_seq"
    )


def read_all_strings(spark: SparkSession, path: str | list[str], schema=None) -> DataFrame:
    """Every column of a CSV as text; an empty field is null."""
    reader = spark.read.options(header="true", **CSV_OPTIONS)
    return (reader.schema(schema) if schema else reader).csv(path)
