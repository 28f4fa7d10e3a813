"""Delimited extracts: ';'-separated text with a header, UTF-8 or Latin-1.

Row rules: a line with more fields than the header is skipped, also when the
fields too many are empty; a shorter line is padded with NULL; quoted fields may
hold the separator; empty fields, quoted or not, and the usual words for a
missing value are NULL. Every raw column is read as STRING; typing happens
later with explicit parsers.

Long lines are caught with one extra trailing ``_overflow`` column in the read
schema and the reader's raw line: normal lines have a field too few for that
schema, so their raw line is there, and its separators outside quotes are
counted; a line without a raw line filled the extra column.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import spec
from ..operators.relational import checked_broadcast
from ..session import materialize
from . import store
from .quoted import AT, BLOCK, FILE, quoted_records

OVERFLOW = "_overflow"
RAW = "_raw"
ENCODINGS = {"utf-8": "UTF-8", "latin-1": "ISO-8859-1"}
# Texts that a lenient reader takes for a missing value.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
           "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def header_columns(spark: SparkSession, path, sep: str = ";",
                   encoding: str = "UTF-8") -> list[str]:
    """Column names from the header line, made unique ignoring case.

    Spark resolves names case-insensitively, so a header with both 'NPS' and
    'nps' (or a repeated name) would make every later reference ambiguous;
    later duplicates get a '__2', '__3', ... suffix.
    """
    first = (spark.read.option("header", False).option("sep", sep).option("quote", '"')
             .option("escape", '"').option("encoding", encoding).csv(path).first())
    if first is None:
        return []
    return unique_names([v if v is not None else f"_c{i}" for i, v in enumerate(first)])


def unique_names(names: list[str]) -> list[str]:
    seen: dict[str, int] = {}
    out = []
    for n in names:
        k = n.lower()
        if k in seen:
            seen[k] += 1
            cand = f"{n}__{seen[k]}"
            while cand.lower() in seen:
                seen[k] += 1
                cand = f"{n}__{seen[k]}"
            seen[cand.lower()] = 1
            out.append(cand)
        else:
            seen[k] = 1
            out.append(n)
    return out


def file_layouts(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(encoding, header, files): the files that share both. A file is 'utf-8'
    when every line of it is valid UTF-8, else 'latin-1'.

    The lines are read once in tasks (the text reader keeps raw bytes); the
    aggregate keeps a flag and the first line of each file.
    """
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths))
    per_file = (lines.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("at"),
                             F.monotonically_increasing_id().alias("n"), F.is_valid_utf8("value").alias("ok"),
                             F.col("value").cast("binary").alias("line"))
                .groupBy("f").agg(F.bool_and("ok").alias("ok"), F.min_by("line", F.struct("at", "n")).alias("header")))
    encoding = F.when(F.col("ok"), "utf-8").otherwise("latin-1")
    return per_file.groupBy(encoding.alias("encoding"), "header").agg(F.collect_list("f").alias("files"))


def file_encodings(spark: SparkSession, paths: str | Sequence[str]) -> dict[str, str]:
    """{file: encoding}"""
    return {f: r["encoding"] for r in file_layouts(spark, paths).collect() for f in r["files"]}


def _read(spark, paths, columns, sep, encoding, multi_line, place=False):
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW}
    if multi_line == "split":
        # Plain names: the schema is parsed from text. The first record of a file is its header.
        schema = ", ".join(f"c{i} string" for i in range(len(columns))) + f", {OVERFLOW} string, {RAW} string"
        records = quoted_records(spark, paths, sep, encoding).where("block > 0 OR at > 0")
        df = records.select(F.col("file").alias(FILE), F.col("block").alias(BLOCK), F.col("at").alias(AT),
                            F.from_csv("text", schema, options).alias("r"))
        df = df.select(FILE, BLOCK, AT, *[F.col(f"r.c{i}").alias(c) for i, c in enumerate(columns)], f"r.{OVERFLOW}", f"r.{RAW}")
        where = [FILE, BLOCK, AT]
    else:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns]
                              + [T.StructField(OVERFLOW, T.StringType()), T.StructField(RAW, T.StringType())])
        df = (spark.read.schema(schema).option("header", True).option("enforceSchema", True)
              .option("encoding", encoding).options(**options).option("multiLine", multi_line)
              .option("columnPruning", False)  # the raw line of a row is there only if all its fields are parsed
              .csv(paths))
        where = [F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK),
                 F.monotonically_increasing_id().alias(AT)]
    outside = F.regexp_replace(RAW, '"[^"]*"', "")
    fields = F.length(outside) - F.length(F.replace(outside, F.lit(sep), F.lit(""))) + 1
    rows = df.where(F.col(OVERFLOW).isNull() & F.col(RAW).isNotNull() & (fields <= len(columns)))
    values = [F.when(~F.col(f"`{c}`").isin(*MISSING), F.col(f"`{c}`")).alias(c) for c in columns]
    return rows.select(*values, *(where if place else []))


def _numbered(rows: DataFrame, name: str) -> DataFrame:
    """Rows with their number in place of file, block and place in the block: the rows of the blocks before
    (files by path, blocks by begin) and those before it in its block."""
    written = materialize(rows, "placed-rows")
    # A block is read by one task in its order, so places in it ascend; records mended at its end come last.
    starts = written.groupBy(FILE, BLOCK).agg(F.count(F.lit(1)).alias("__n"), F.min(AT).alias("__first"), F.max(AT).alias("__last"))
    before = Window.orderBy(FILE, BLOCK).rowsBetween(Window.unboundedPreceding, -1)  # a row per block
    above = starts.withColumn("__above", F.coalesce(F.sum(F.col("__last") - F.col("__first") + 1).over(before), F.lit(0)))
    here = checked_broadcast(above.select(F.col(FILE).alias("__f"), F.col(BLOCK).alias("__b"), "__first", "__above"))
    joined = written.join(here, (F.col(FILE) == F.col("__f")) & (F.col(BLOCK) == F.col("__b")))
    number = (F.col("__above") + F.col(AT) - F.col("__first")).cast("long").alias(name)
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns if c not in (FILE, BLOCK, AT)], number)


def read_delimited(spark: SparkSession, path: str | Sequence[str], sep: str = ";", encoding: str | None = None,
                   multi_line: bool | str = False, row_number: str | None = None) -> DataFrame:
    """Read one extract: a file, a folder of files, or a list of files.

    ``encoding=None`` decides per file (UTF-8 if valid, else Latin-1); pass
    'UTF-8' or 'ISO-8859-1' to force one. Files are read in groups of one
    encoding and one header line, and put together by column name: columns
    may stand in another order in another file.

    Fields with line breaks in quotes need ``multi_line``: 'split' lets many
    tasks read one file (lines end with ``\\n`` or ``\\r\\n``), True reads each
    file in one task.

    ``row_number`` names a column for the rows' order in the extract: ascending
    numbers, files by path and rows as they stand in them, however the files
    are split. The rows are written once for it. Within a block the numbers of
    skipped lines may be left out or not.
    """
    groups = [(r["encoding"], r["files"]) for r in file_layouts(spark, path).orderBy("encoding", "header").collect()]
    place = row_number is not None
    if not groups:  # no lines at all
        path = path if isinstance(path, str) else list(path)
        out = _read(spark, path, header_columns(spark, path, sep), sep, "UTF-8", multi_line is True, place)
        return _numbered(out, row_number) if place else out
    out = None
    for enc, files in groups:
        cs = encoding or ENCODINGS[enc]
        part = _read(spark, files, header_columns(spark, files[0], sep, cs), sep, cs, multi_line, place)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return _numbered(out, row_number) if place else out


def _reason(e: Exception) -> str:
    """The innermost cause that the error names, else its first line."""
    lines = [x.strip() for x in str(e).splitlines() if x.strip()]
    causes = [x for x in lines if x.startswith("Caused by: ")]
    return (causes[-1].removeprefix("Caused by: ") if causes else lines[0] if lines else type(e).__name__)[:500]


def broken_files(spark: SparkSession, files: Sequence[str]) -> dict[str, str]:
    """{file: reason} of the files that cannot be read to their end, or have no line."""
    out = {}
    for f in files:  # a job per file; asked for only when their extract has failed as a whole
        try:
            if not file_layouts(spark, f).collect():
                out[f] = "no lines"
        except (PySparkException, Py4JJavaError) as e:
            out[f] = _reason(e)
    return out


def read_sources(spark: SparkSession, root: str, names: Iterable[str], suffix: str = spec.EXTRACT_SUFFIX,
                 reader=read_delimited, **kw) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Read each named extract under ``root``; a missing or unreadable one is
    skipped and reported (name -> error), not fatal.

    The reader looks through all files once to tell their encodings, so a file that breaks
    off (a truncated archive, say) is found here. Of an extract of several files
    the others are read, and the broken ones reported as ``name/file``. One without any line
    is skipped.
    """
    frames: dict[str, DataFrame] = {}
    skipped: dict[str, str] = {}
    for name in names:
        path = f"{root.rstrip('/')}/{name}{suffix}"
        try:
            frame = reader(spark, path, **kw)
        except AnalysisException as e:
            skipped[name] = str(e).splitlines()[0]
            continue
        except (PySparkException, Py4JJavaError) as e:
            files = store.files(spark, path)
            broken = broken_files(spark, files) if len(files) > 1 else {}
            good = [f for f in files if f not in broken]
            if not broken or not good:
                skipped[name] = _reason(e)
                continue
            skipped |= {f"{name}/{f.rpartition('/')[2]}": why for f, why in broken.items()}
            frame = reader(spark, good, **kw)
        if frame.columns:
            frames[name] = frame
        else:
            skipped[name] = "no lines"
    return frames, skipped
