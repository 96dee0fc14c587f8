"""Files of delimited text: listing, classification, decoding, lines and cells, with failures as rows."""

from __future__ import annotations

from collections.abc import Mapping
from fnmatch import fnmatch

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratakit import constants as K
from stratakit.operators import sheets
from stratakit.session import salted_join


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, file_name, suffix, kind, record, nzgd_id, length, content) of every file below ``path``, one directory per record.

    ``content`` is read only when it is used.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    nothing = empty_files(spark, path, glob).select("path", F.lit(0).cast("long").alias("length"), F.lit(b"").alias("content"))
    return with_names(files.select("path", "length", "content").unionByName(nothing))


def with_names(files: DataFrame) -> DataFrame:
    decoded = F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B")))
    name = F.element_at(F.split(decoded, "/"), -1)
    record = F.element_at(F.split(decoded, "/"), -2)
    suffix = F.lower(F.regexp_extract(name, r"(\.[^.]+)$", 1))
    kind = F.coalesce(F.create_map(*[F.lit(x) for kv in K.FILE_KINDS.items() for x in kv])[suffix], F.lit("unknown"))
    return files.select(
        "path", name.alias("file_name"), suffix.alias("suffix"), kind.alias("kind"), record.alias("record"),
        F.regexp_extract(record, r"^[^_]*_(\d+)", 1).try_cast("int").alias("nzgd_id"), "length", "content",
    )


def empty_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path) of the files without any byte, which the binary reader does not list."""
    sc = spark.sparkContext
    root = sc._jvm.org.apache.hadoop.fs.Path(path)
    found = root.getFileSystem(sc._jsc.hadoopConfiguration()).listFiles(root, True)
    empty = []
    while found.hasNext():
        f = found.next()
        if f.getLen() == 0 and fnmatch(f.getPath().getName(), glob):
            empty.append((f.getPath().toString(),))
    return spark.createDataFrame(empty, "path string")


def refused(files: DataFrame, special: Mapping[str, tuple[str, str]] = K.SPECIAL_CASES) -> DataFrame:
    """(path, record, file_name, category, details) of data files that are never opened: names without ``_`` and known special cases.

    A file belongs to the record that the first two parts of its name give.
    """
    parts = F.split("file_name", "_")
    named = F.concat_ws("_", parts[0], F.try_element_at(parts, F.lit(2)))
    case = lambda k: F.create_map(*[F.lit(x) for name, pair in special.items() for x in (name, pair[k])])[named]
    odd = ~F.col("file_name").contains("_")
    data = files.where(F.col("kind").isin("spreadsheet", "ags")).select(
        "path", "record", "file_name", F.when(odd, "bad_file_name_format").otherwise(case(0)).alias("category"),
        F.when(odd, F.concat("file_name", F.lit(" has no record name"))).otherwise(case(1)).alias("details"),
    )
    return data.where("category is not null")


def listing_failures(files: DataFrame, special: Mapping[str, tuple[str, str]] = K.SPECIAL_CASES) -> DataFrame:
    """Failure rows that need no content: records with nothing but nondata files, and the files of :func:`refused`."""
    by_record = files.groupBy("record").agg(F.count_if(F.col("kind").isin("spreadsheet", "ags")).alias("n"), F.min("file_name").alias("file_name"))
    none = by_record.where("n = 0").select("record", "file_name", F.lit("no_data_files").alias("category"), F.lit("only nondata files").alias("details"))
    return none.unionByName(refused(files, special).drop("path"))


def decode(content: Column) -> Column:
    """UTF-8 where valid, else Latin-1; line ends become ``\\n``."""
    text = F.when(F.is_valid_utf8(content.cast("string")), content.cast("string")).otherwise(F.decode(content, "ISO-8859-1"))
    return F.regexp_replace(text, "\r\n?", "\n")


def file_lines(files: DataFrame) -> DataFrame:
    """(path, row, line) of the text files, rows counted from 0. One file is one row of input, so it must fit into memory."""
    text = files.where(F.col("suffix").isin(".csv", ".txt")).select("path", F.split(decode(F.col("content")), "\n").alias("lines"))
    return text.select("path", F.posexplode("lines").alias("row", "line")).where("line <> ''")


def grid(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((path, row, cells), failures): lines cut at each file's most frequent delimiter."""
    counts = sheets.delimiter_counts(lines, "path", "line")
    failures = counts.where("delimiter is null").select("path", F.lit("no_data").alias("category"), F.lit("no_delimiter_found").alias("details"))
    known = salted_join(lines, counts.where("delimiter is not null"), ["path"], "inner", ["row"])
    clean = F.when(F.col("delimiter").isin(",", ";"), sheets.without_quoted_delimiters(F.col("line"), F.col("delimiter"))).otherwise(F.col("line"))
    return known.select("path", "row", sheets.split_cells(clean, F.col("delimiter")).alias("cells")), failures


def load(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(measurements, failures) of every delimited text file below ``path``."""
    files = list_files(spark, path)
    lines, unsplit = grid(file_lines(files))
    good, failed = sheets.extract(lines, "path")
    empty = files.where(F.col("suffix").isin(".csv", ".txt") & (F.col("length") == 0)).select("path", F.lit("no_data").alias("category"), F.lit("empty file").alias("details"))
    return good, failed.unionByName(unsplit).unionByName(empty)
