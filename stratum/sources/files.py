"""Landing-zone files: discovery, string-safe scans, rescue of bad rows
(SRC2-SRC7, SRC13, SRC16, SRC17).

Bronze keeps every source column as text; values that do not fit the row
layout are kept, not dropped: the raw line goes to ``_rescued_data`` as JSON
together with the file it came from.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators.ordered import running_sum
from stratum.session import scratch_path

CORRUPT = "_corrupt_record"
RESCUED = "_rescued_data"
RECORD_LINES = 10_000       # lines a quoted field may span; beyond that the quote is a stray one
MOST_FIELDS = 10_000        # columns that a table may get from JSON keys


@dataclass(frozen=True)
class Source:
    """One registry entry: one landed file family -> one bronze table."""

    table: str
    subdir: str                      # folder of the landing zone
    pattern: str = "*"               # file-name filter inside the folder
    fmt: str = "csv"                 # csv | json | arff
    sep: str = ","
    header: bool = True
    columns: tuple[str, ...] = ()    # the table's columns; needed for headerless layouts
    escape: str = '"'                # what stands before a quote inside quotes
    pii: tuple[str, ...] = ()
    tags: dict = field(default_factory=dict)


# ----------------------------------------------------------------- helpers
def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem (works on any store)."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def has_files(spark: SparkSession, folder: str, pattern: str = "*") -> bool:
    """True if some file in ``folder`` (or below) matches ``pattern``."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return False
    jvm = spark.sparkContext._jvm
    for glob in (f"{folder.rstrip('/')}/{pattern}", f"{folder.rstrip('/')}/**/{pattern}"):
        hits = fs.globStatus(jvm.org.apache.hadoop.fs.Path(glob))
        if hits is not None and len(hits) > 0:
            return True
    return False


def write_text_file(spark: SparkSession, path: str, text: str) -> None:
    """Small control file (e.g. a version pointer), overwritten atomically
    enough for a single writer: write a temp file, then rename."""
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if fs.exists(p):
        fs.delete(p, False)
    fs.rename(tmp, p)


def create_text_file(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file that must not exist yet; whether this call did.  Of
    several writers, one creates it.  A failure while writing leaves it cut
    short, so readers should look for a last line."""
    fs, p = _fs(spark, path)
    try:
        out = fs.create(p, False)
    except Py4JJavaError as e:
        if fs.exists(p):
            return False
        raise e
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    return True


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if it doesn't exist."""
    fs, p = _fs(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return fs.getContentSummary(p).getLength()


def files_in(spark: SparkSession, path: str) -> int:
    """The most data files that a folder or one of its sub-folders holds."""
    fs, p = _fs(spark, path)
    per_folder: dict[str, int] = {}
    found = fs.listFiles(p, True)
    while found.hasNext():
        file = found.next().getPath()
        if not file.getName().startswith(("_", ".")):
            folder = file.getParent().toString()
            per_folder[folder] = per_folder.get(folder, 0) + 1
    return max(per_folder.values(), default=0)


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def read_text_file(spark: SparkSession, path: str) -> str | None:
    """A small control file through the Hadoop FileSystem; None if absent."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def list_landing(spark: SparkSession, landing: str) -> DataFrame:
    """Files present in the landing zone (path, folder, name, bytes,
    modified), via the ``binaryFile`` source with the content column pruned,
    so no file body is read."""
    if not path_exists(spark, landing):
        return spark.createDataFrame([], "path string, folder string, name string, bytes long, modified timestamp")
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing)
          .select("path", "length", "modificationTime"))
    parts = F.split(F.col("path"), "/")
    return df.select("path", F.element_at(parts, -2).alias("folder"),
                     F.element_at(parts, -1).alias("name"),
                     F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def head_lines(spark: SparkSession, path: str, n: int = 1) -> list[str]:
    """The first ``n`` lines of a file, read through the Hadoop FileSystem:
    a few KB per file, whatever its size."""
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        lines = []
        while len(lines) < n and (line := reader.readLine()) is not None:
            lines.append(line)
        return lines
    finally:
        reader.close()


def header_names(line: str, sep: str) -> tuple[str, ...]:
    """Column names of a header line; blank and repeated names get their place."""
    names: list[str] = []
    for i, name in enumerate(next(csv.reader([line.lstrip("\ufeff")], delimiter=sep), [])):
        name = name.strip() or f"_c{i}"
        names.append(name if name.lower() not in {n.lower() for n in names} else f"{name}_{i}")
    return tuple(names)


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))


def _aligned(rows: DataFrame, have: Sequence[str], canonical: Sequence[str]) -> DataFrame:
    """Rows with one struct ``r`` of the columns ``have`` (and the corrupt
    record) on the ``canonical`` columns, by name: what a file lacks is NULL,
    what only the file has goes to ``_rescued_data`` with the raw line of a
    row that doesn't fit its header."""
    by_name = {n.lower(): n for n in have}
    known = {n.lower() for n in canonical}
    cols = [(F.col(f"r.`{by_name[n.lower()]}`") if n.lower() in by_name else F.lit(None).cast("string")).alias(n)
            for n in canonical]
    other = [n for n in have if n.lower() not in known]
    extra = (F.map_filter(F.create_map(*[x for n in other for x in (F.lit(n), F.col(f"r.`{n}`"))]),
                          lambda k, v: v.isNotNull()) if other else F.lit(None).cast("map<string,string>"))
    extra = F.when(F.size(extra) > 0, extra)
    raw = F.col(f"r.{CORRUPT}")
    rescue = F.when(raw.isNotNull() | extra.isNotNull(), _json(raw=raw, extra=extra, file=F.col("_file")))
    return rows.select(*cols, rescue.alias(RESCUED), F.col("_file").alias("_source_file"))


def text_lines(reader, folder: str, src: Source):
    """Lines of the source's files with the file and the part of it (block)
    they are from; ``reader`` is ``spark.read`` or ``spark.readStream``."""
    return (reader.option("pathGlobFilter", src.pattern).text(folder)
            .select("value", F.col("_metadata.file_path").alias("_file"),
                    F.col("_metadata.file_block_start").alias("_block")))


def _written(lines: DataFrame) -> DataFrame:
    """The lines, read once, with their place in their file: by block, then by
    ``_seq``.  A byte order mark before a file's first line is dropped."""
    path = scratch_path(lines.sparkSession, "materialized", "landed_lines")
    bare = F.when((F.col("_block") == 0) & F.col("value").startswith("\ufeff"), F.substring("value", 2, 1 << 30)) \
        .otherwise(F.col("value"))
    (lines.select(bare.alias("value"), "_file", "_block", F.monotonically_increasing_id().alias("_seq"))
     .write.parquet(path))
    return lines.sparkSession.read.parquet(path)


def records(lines: DataFrame, sep: str, escape: str = '"') -> DataFrame:
    """Delimited records of numbered ``lines`` (``value, _file, _block, _seq``):
    lines that a quoted field spans are joined by line feeds.

    Only files in which some line has an odd number of quotes are looked at.
    There, a line with an odd number opens a quoted field if, beside its complete
    ones, a quote begins a field, and otherwise can only close one.  Whether a line begins
    inside quotes is the parity of the opening lines since the last that could
    only close: running sums over the blocks of a file, whose totals are carried
    from block to block, so a file is split like any other.  A quote that is
    never closed, or only after ``RECORD_LINES`` lines, is a stray one: its lines
    are records of their own."""
    bare = (F.replace(F.col("value"), F.lit('""'), F.lit("")) if escape == '"'
            else F.regexp_replace("value", re.escape(escape) + ".", ""))
    odd = (F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))) % 2 == 1
    first = f"(^|{re.escape(sep)})\\s*"
    left = F.regexp_replace(bare, first + f'"[^"]*"(?=\\s*({re.escape(sep)}|$))', "$1")
    begins = left.rlike(first + '"')
    marked = lines.withColumn("_odd", odd).withColumn("_opens", odd & begins)
    files = marked.where("_odd").select("_file").distinct()
    if files.isEmpty():
        return lines
    slim = (marked.select("_file", "_block", "_seq", "_opens", (F.col("_odd") & ~F.col("_opens")).alias("_closes"))
            .join(files, "_file", "left_semi"))
    place, block = ["_block", "_seq"], F.col("_block")
    slim = running_sum(slim, ["_file"], place, block, F.col("_closes").cast("int"), "_run")
    # a line that can only close belongs to the run that it ends
    slim = slim.withColumn("_run", F.col("_run") - F.col("_closes").cast("int"))
    slim = running_sum(slim, ["_file", "_run"], place, block, F.col("_opens").cast("int"), "_seen")
    inside = (F.col("_seen") - F.col("_opens").cast("int")) % 2 == 1
    slim = slim.withColumn("_inside", inside)
    slim = running_sum(slim, ["_file"], place, block, (~F.col("_inside")).cast("int"), "_record")
    ends = F.col("_inside") & (F.col("_opens") | F.col("_closes"))
    whole = (slim.groupBy("_file", "_record").agg(F.count("*").alias("_n"), F.max(ends).alias("_ended"))
             .where((F.col("_n") > 1) & (F.col("_n") <= RECORD_LINES) & F.col("_ended")))
    parts = slim.select("_file", "_block", "_seq", "_record").join(whole.select("_file", "_record"),
                                                                    ["_file", "_record"])
    path = scratch_path(lines.sparkSession, "materialized", "record_parts")
    parts.write.parquet(path)
    parts = lines.sparkSession.read.parquet(path)
    key = ["_file", "_block", "_seq"]
    joined = (lines.join(parts, key).groupBy("_file", "_record")
              .agg(F.sort_array(F.collect_list(F.struct("_block", "_seq", "value"))).alias("p"))
              .select(F.array_join("p.value", "\n").alias("value"), "_file", F.col("p")[0]["_block"].alias("_block"),
                      F.col("p")[0]["_seq"].alias("_seq")))
    return lines.join(parts, key, "left_anti").select("value", *key).unionByName(joined)


def parse_csv(lines: DataFrame, src: Source, canonical: Sequence[str] | None = None,
              evolve: bool = False) -> DataFrame:
    """Delimited lines on the ``canonical`` columns (default: those of the
    first file's header), every value as text.

    The lines are read once.  Each file is read by its own header, so files may
    order, rename, add or lack columns.  A header is a file's first record that
    isn't blank; files with equal headers are parsed together.  A repeat of the
    header is no row, nor is a blank line outside quotes.  With ``evolve``,
    columns that only the files have are added to the canonical ones instead of
    being rescued."""
    spark = lines.sparkSession
    rows = records(_written(lines), src.sep, src.escape).where(F.length(F.trim("value")) > 0)
    if not src.header:
        if not src.columns:
            raise ValueError(f"headerless source {src.table} needs explicit column names")
        groups = {None: src.columns}
        tagged = rows.withColumn("_header", F.lit(None).cast("string"))
    else:
        # a row for each of the batch's files
        heads = rows.groupBy("_file").agg(F.min_by("value", F.struct("_block", "_seq")).alias("_header"))
        found = sorted(tuple(r) for r in heads.collect())
        groups = {h: header_names(h, src.sep) for _, h in found}
        of_file = spark.createDataFrame(found, "_file string, _header string")
        tagged = rows.join(F.broadcast(of_file), "_file").where(F.col("value") != F.col("_header"))
    canonical = list(canonical or next(iter(groups.values()), src.columns or ()))
    if evolve:
        canonical = with_new_columns(canonical, groups.values())
    if not groups:
        return rows.select(*[F.lit(None).cast("string").alias(n) for n in canonical],
                           F.lit(None).cast("string").alias(RESCUED), F.col("_file").alias("_source_file")).limit(0)
    out = []
    for header, names in groups.items():
        ddl = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in (*names, CORRUPT))
        options = {"sep": src.sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "escape": src.escape}
        own = tagged if header is None else tagged.where(F.col("_header") == header)
        out.append(_aligned(own.select(F.from_csv("value", ddl, options).alias("r"), "_file"), names, canonical))
    return reduce(DataFrame.unionByName, out)


def with_new_columns(columns: Sequence[str], others) -> list[str]:
    """``columns`` and, in order, what ``others`` have besides (in any case)."""
    out, known = list(columns), {c.lower() for c in columns}
    for names in others:
        for n in names:
            if n.lower() not in known:
                known.add(n.lower())
                out.append(n)
    return out


def json_fields(rows: DataFrame) -> list[str]:
    """The keys that occur in the maps ``m``, at most ``MOST_FIELDS``: keys that
    are data (ids, times) are no columns."""
    found = rows.select(F.explode(F.map_keys("m"))).distinct().limit(MOST_FIELDS + 1).collect()
    if len(found) > MOST_FIELDS:
        raise ValueError(f"more than {MOST_FIELDS} different JSON keys; name the fields of the table")
    return sorted(r[0] for r in found)


def parse_json(lines: DataFrame, canonical: Sequence[str] | None = None, evolve: bool = False) -> DataFrame:
    """JSON lines on the ``canonical`` fields (default: all fields that occur),
    every value as text; other fields (unless ``evolve`` adds them) and
    malformed lines are rescued."""
    rows = lines.where(F.length(F.trim("value")) > 0).withColumn(
        "m", F.from_json("value", "map<string,string>", {"mode": "PERMISSIVE"}))
    if canonical is None:
        canonical = json_fields(rows)
    elif evolve:
        canonical = with_new_columns(canonical, [json_fields(rows)])
    names = F.array(*[F.lit(n) for n in canonical]) if canonical else F.array().cast("array<string>")
    extra = F.map_filter("m", lambda k, v: ~F.array_contains(names, k))
    extra = F.when(F.size(extra) > 0, extra)
    raw = F.when(F.col("m").isNull(), F.col("value"))
    rescue = F.when(raw.isNotNull() | extra.isNotNull(), _json(raw=raw, extra=extra, file=F.col("_file")))
    return rows.select(*[F.col("m").getItem(n).alias(n) for n in canonical], rescue.alias(RESCUED),
                       F.col("_file").alias("_source_file"))


def scan_csv(spark: SparkSession, path: str, src: Source) -> DataFrame:
    """Batch string-safe CSV scan with the rescue column and source file."""
    return parse_csv(text_lines(spark.read, path, src), src)


def scan_json(spark: SparkSession, path: str, src: Source, names: Sequence[str] | None = None) -> DataFrame:
    """JSON landing scan, every field as string, nothing lost."""
    return parse_json(text_lines(spark.read, path, src), names)


ARFF_HEADER_LINES = 100_000         # lines in which an ARFF header must end


def scan_arff(spark: SparkSession, path: str) -> DataFrame:
    """ARFF -> all-string table: attribute names from the ``@attribute`` lines
    of the files' heads (the data isn't scanned for them), data rows parsed
    with ``from_csv`` in parallel; ``?`` (ARFF missing) becomes NULL, and a row
    with too many or too few tokens keeps its raw line in ``_rescued_data``."""
    attrs: list[str] = []
    for f in sorted(r["path"] for r in list_landing(spark, path).select("path").collect()):
        head = head_lines(spark, f)
        if not head or not head[0].lstrip().startswith(("@", "%")):
            continue                    # a file of data rows
        for line in head_lines(spark, f, ARFF_HEADER_LINES):
            found = re.match(r"(?i)\s*@attribute\s+(?:'([^']+)'|(\S+))", line)
            if found:
                attrs.append(found[1] or found[2])
            elif re.match(r"(?i)\s*@data", line):
                break
    if not attrs:
        raise ValueError(f"no @attribute lines in {path}")
    lines = (spark.read.option("recursiveFileLookup", "true").text(path)
             .select("value", F.col("_metadata.file_path").alias("_file")))
    body = lines.where(~F.trim("value").startswith("@") & ~F.trim("value").startswith("%")
                       & (F.length(F.trim("value")) > 0))
    ddl = ", ".join(f"`{n}` STRING" for n in (*attrs, CORRUPT))
    parsed = body.select(F.from_csv("value", ddl, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
                         .alias("r"), "_file")
    rows = _aligned(parsed, attrs, attrs)
    return rows.select(*[F.when(F.col(f"`{a}`") != "?", F.col(f"`{a}`")).alias(a) for a in attrs], RESCUED)


def list_tables(spark: SparkSession, root: str, suffix: str = ".parquet") -> list[str]:
    """Table names under a folder (``<name>.parquet`` files or folders): the
    path-layout equivalent of ``SHOW TABLES``; a metadata listing, one entry
    per table, no data read."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted(n[: len(n) - len(suffix)] for n in names if n.endswith(suffix) and not n.startswith(("_", ".")))


def partition_values(spark: SparkSession, path: str, column: str) -> list[int]:
    """The values of an integer partition column that a written table has: a
    listing of its folders."""
    fs, p = _fs(spark, path)
    names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{column}="))


def write_arff(df: DataFrame, path: str, relation: str) -> None:
    """Land a frame as ARFF: a header file plus data files written in
    parallel (values rendered as text; decimals never in exponent form)."""
    spark = df.sparkSession
    header = [f"@RELATION {relation}", ""] + [f"@ATTRIBUTE {c} STRING" for c in df.columns] + ["", "@DATA"]
    spark.createDataFrame([(line,) for line in header], "value string").coalesce(1) \
        .write.mode("overwrite").text(f"{path}/h")
    body = df.select(F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("?"))
                                        for c in df.columns]).alias("value"))
    body.write.mode("overwrite").text(f"{path}/d")
