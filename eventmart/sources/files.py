"""Log files: listing, order, limit, content ids, ingest manifest and line scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart.functions.naming import epoch_seconds, file_time, output_name
from eventmart.operators.keys import broadcast_if_small

LOG_GLOB = "*.jsnl"
UNFINISHED = "current"

# n_lines: lines that a run took in; line_count and lines_id: all lines of the file then, and their digest
MANIFEST = (
    "file_name string, file_id string, length bigint, mtime double, n_lines bigint, ingested_at string, path string, "
    "uri string, line_count bigint, lines_id string"
)


def list_files(spark: SparkSession, path: str | list[str], *, glob: str = LOG_GLOB,
               exclude: str = UNFINISHED) -> DataFrame:
    """(path, file_name, mtime, length, uri, file_ts); reads no content. ``path``: a directory, or single files.

    Files of length zero hold no lines and are not listed.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    name = F.col("_metadata.file_name")
    listing = files.where(~F.contains(name, F.lit(exclude))).select(
        "path", name.alias("file_name"), epoch_seconds(F.col("modificationTime")).alias("mtime"), "length",
        F.col("_metadata.file_path").alias("uri"),
    )
    return with_file_ts(listing)


def with_file_ts(listing: DataFrame) -> DataFrame:
    """Add ``file_ts``: the time in the file name, or else the modification time ``mtime``."""
    return listing.withColumn("file_ts", F.coalesce(file_time(F.col("file_name")), "mtime"))


def pick_files(listing: DataFrame, n: int | None = None) -> DataFrame:
    """The first ``n`` files by the time in their name, else by modification time; 0 or None: all."""
    ordered = listing.orderBy("file_ts", "file_name", *[c for c in ("path",) if c in listing.columns])
    return ordered.limit(n) if n else ordered


def changed_files(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files not known by place, length and modification time: only their content needs a look.

    A manifest or listing without places is compared by name.
    """
    shared = [c for c in ("uri", "path", "file_name") if c in manifest.columns and c in listing.columns]
    same = [shared[0], "length", "mtime"]
    return listing.join(manifest.select(*same), same, "left_anti")


def once(files: DataFrame) -> DataFrame:
    """Of files with the same name and content, in several folders, the one with the least path."""
    first = files.groupBy("file_name", "file_id").agg(F.min("path").alias("path")).select("path")
    return files.join(first, "path", "left_semi")


def file_key(name: Column, uri: Column, repeated: list[str]) -> Column:
    """The name, with its folder where files of several folders have that name."""
    folder = F.regexp_replace(uri, "/[^/]*$", "")
    return F.when(name.isin(repeated), F.concat(name, F.lit("@"), folder)).otherwise(name) if repeated else name


def new_files(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files whose name and content were not ingested before."""
    return listing.join(manifest.select("file_name", "file_id"), ["file_name", "file_id"], "left_anti")


def scan_lines(spark: SparkSession, paths: str | list[str], *, glob: str = LOG_GLOB,
               exclude: str = UNFINISHED, repeated: list[str] | None = None) -> DataFrame:
    """Lines of a directory or of given files with their place in the run: (file, split, line).

    Files whose names are in ``repeated`` are told apart by their folders, which then follow the name in ``file_name``.
    """
    text = spark.read.option("lineSep", "\n").option("pathGlobFilter", glob).text(paths)
    return order_lines(with_metadata(text, exclude, repeated))


def with_metadata(text: DataFrame, exclude: str = UNFINISHED, repeated: list[str] | None = None) -> DataFrame:
    """File name, time and split of each line; the name filter comes first so that it prunes files."""
    name = F.col("_metadata.file_name")
    return text.where(~F.contains(name, F.lit(exclude))).select(
        F.coalesce(file_time(name), epoch_seconds(F.col("_metadata.file_modification_time"))).alias("file_ts"),
        file_key(name, F.col("_metadata.file_path"), repeated or []).alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_size").alias("length"),
        epoch_seconds(F.col("_metadata.file_modification_time")).alias("mtime"),
    )


def order_lines(lines: DataFrame) -> DataFrame:
    """Within a split of a file the row number grows with the line; (block, ord) orders the file."""
    return lines.select("file_ts", "file_name", "block", F.monotonically_increasing_id().alias("ord"), "line")


def files_of_lines(lines: DataFrame) -> DataFrame:
    """The listing of the files that lines of ``with_metadata`` come from."""
    listing = lines.select("uri", "file_name", "length", "mtime").distinct()
    return with_file_ts(listing.withColumn("path", F.col("uri")))


def repeated_names(listing: DataFrame) -> list[str]:
    """The names that several files of a listing have."""
    return sorted(r.file_name for r in listing.groupBy("file_name").agg(F.count("*").alias("n")).where("n > 1").collect())


def with_file_ids(spark: SparkSession, listing: DataFrame) -> DataFrame:
    """Add ``file_id`` to a listing: equal ids mean equal content.

    One digest for files of any size, added up split by split; with the length it also tells whether the last line is ended.
    The driver holds the paths of the listing, as the scan's own file index does.
    """
    paths = [r.path for r in listing.select("path").toLocalIterator()]
    if not paths:
        return listing.withColumn("file_id", F.lit(None).cast("string"))
    repeated = repeated_names(listing)
    lines = scan_lines(spark, paths, glob="*", exclude="\u0000", repeated=repeated)
    digests = line_digest(lines).select(F.col("file_name").alias("_key"), F.col("file_id").alias("lines_id"), "line_count")
    keyed = listing.withColumn("_key", file_key(F.col("file_name"), F.col("uri"), repeated))
    return keyed.join(digests, "_key", "left").withColumn("file_id", content_id()).drop("_key")


def content_id() -> Column:
    """Equal ids mean equal content: the length beside the digest tells whether the last line is ended."""
    return F.md5(F.concat_ws(":", F.col("length").cast("string"), "lines_id"))


def last_entries(manifest: DataFrame) -> DataFrame:
    """(uri, file_name, seen): each place as it was last taken in."""
    seen = F.struct("ingested_at", "file_id", "line_count", "lines_id")
    return manifest.where("uri is not null").groupBy("uri", "file_name").agg(F.max(seen).alias("seen"))


def grown(spark: SparkSession, files: DataFrame, manifest: DataFrame) -> DataFrame:
    """(uri, skip): those of ``files`` that begin with all the lines that were taken in from their place before.

    The digest of a file's lines is made of sums, so the one of its first lines is that of the shorter file it was.
    """
    before = last_entries(manifest).select("uri", F.col("seen.line_count").alias("skip"), F.col("seen.lines_id").alias("begin"))
    longer = files.join(before, "uri").where("line_count > skip").select("uri", "path", "file_name", "skip", "begin")
    paths = [r.path for r in longer.select("path").toLocalIterator()]  # one path per file of the run
    if not paths:
        return files.select("uri", F.lit(0).cast("bigint").alias("skip")).limit(0)
    again = repeated_names(longer)
    key = longer.select(file_key(F.col("file_name"), F.col("uri"), again).alias("file_name"), "uri", "skip", "begin")
    lines = numbered(scan_lines(spark, paths, glob="*", exclude="\u0000", repeated=again))
    first = lines.join(broadcast_if_small(key.select("file_name", "skip")), "file_name").where("number < skip")
    return line_digest(first).join(key, "file_name").where("file_id = begin").select("uri", "skip")


def numbered(lines: DataFrame) -> DataFrame:
    """Add ``number``: the place of each line in its file, from 0, whatever the splits. One row per split goes through a window."""
    splits = lines.groupBy("file_name", "block").agg(F.count("*").alias("n"), F.min("ord").alias("low"))
    earlier = Window.partitionBy("file_name").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file_name", "block", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("low")).alias("shift"))
    joined = lines.join(broadcast_if_small(splits), ["file_name", "block"])
    return joined.select(*lines.columns, (F.col("ord") + F.col("shift")).alias("number"))


# Fixed value: the modulus of the digest; products of two residues fit a BIGINT.
_PRIME = 2147483647


def line_digest(lines: DataFrame) -> DataFrame:
    """(file_name, file_id, line_count) from all lines and their numbers, whatever the splits.

    With h the hash and i the number of a line, the sums of h and of h * i (mod a prime) describe a
    file. Each split adds up h and h * row id; the number of lines before the split and its lowest
    row id then turn row ids into line numbers, so no task ever sees a whole file.
    """
    hashes = [F.pmod(F.xxhash64("line", F.lit(seed)), F.lit(_PRIME)) for seed in range(4)]
    row = F.pmod("ord", F.lit(_PRIME))
    sums = [F.sum(h).alias(f"s{i}") for i, h in enumerate(hashes)]
    weighted = [F.sum(F.pmod(h * row, F.lit(_PRIME))).alias(f"w{i}") for i, h in enumerate(hashes)]
    splits = lines.groupBy("file_name", "block").agg(
        F.count("*").alias("n"), F.min("ord").alias("low"), F.sum(F.octet_length("line")).alias("bytes"),
        *sums, *weighted,
    )
    earlier = Window.partitionBy("file_name").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("shift", F.pmod(F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("low"), F.lit(_PRIME)))
    parts = [F.sum(F.pmod(f"s{i}", F.lit(_PRIME))) for i in range(4)]
    parts += [
        F.sum(F.pmod(F.col(f"w{i}") + F.col("shift") * F.pmod(f"s{i}", F.lit(_PRIME)), F.lit(_PRIME))) for i in range(4)
    ]
    residues = [F.pmod(p, F.lit(_PRIME)).cast("string") for p in parts]
    return splits.groupBy("file_name").agg(
        F.md5(F.concat_ws(":", F.sum("n").cast("string"), F.sum("bytes").cast("string"), *residues)).alias("file_id"),
        F.sum("n").alias("line_count"),
    )


def output_names(listing: DataFrame) -> DataFrame:
    return listing.withColumn("src", output_name(F.col("file_name"), F.col("file_id")))
