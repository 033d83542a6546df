"""Raw landing files."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Mapping

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapcat.model import raw_schema

CORRUPT = "_corrupt_record"
#: Field names and links repeat in every record; readers know the codec by the file's ending.
LANDED = "gzip"


def landing_path(root: str, entity: str, snapshot: str) -> str:
    """One entity of one snapshot: a JSON file, or a folder of them."""
    return f"{root.rstrip('/')}/{entity}/{entity}_{snapshot}.json"


def scan_raw_json(
    spark: SparkSession,
    root: str,
    entity: str,
    snapshot: str,
    multi_line: bool = True,
    field_aliases: Mapping[str, str] | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Typed rows of one raw entity and snapshot under the declared schema.

    A JSON array (``multi_line``) is one document, hence one task per file; land
    large snapshots as many files, or as JSON lines, which split.  An unknown
    entity is a ValueError, a missing path an AnalysisException.
    ``field_aliases`` maps a field name of the files to a column of the schema.
    """
    schema = raw_schema(entity)
    names = {column: field for field, column in (field_aliases or {}).items()}
    fields = [T.StructField(names.get(f.name, f.name), f.dataType) for f in schema.fields]
    reader = spark.read.option("multiLine", multi_line)
    if keep_corrupt:
        fields.append(T.StructField(CORRUPT, T.StringType()))
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    df = reader.schema(T.StructType(fields)).json(landing_path(root, entity, snapshot))
    return df.withColumnsRenamed({field: column for column, field in names.items()})


def corrupt_record_split(scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable rows, malformed records as text); the batch goes on either way.

    Whether a record is malformed depends on the columns that are parsed, so both
    sides must parse all of them.  The fallback in ``coalesce`` is never taken; it
    keeps column pruning from narrowing the malformed side.
    """
    data = [c for c in scanned.columns if c != CORRUPT]
    good = scanned.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    everything = F.to_json(F.struct(*data))
    bad = scanned.filter(F.col(CORRUPT).isNotNull()).select(F.coalesce(F.col(CORRUPT), everything).alias(CORRUPT))
    return good, bad


def array_elements(
    spark: SparkSession, root: str, entity: str, snapshot: str, field_aliases: Mapping[str, str] | None = None
) -> DataFrame:
    """Every element of the JSON arrays of one raw entity and snapshot, judged alone.

    Columns of the schema, ``file``, ``position`` (text pieces of the file, from 0), and the element's text in
    ``CORRUPT`` if it is no object or a field does not fit its type.

    A whole file that parses is taken as it is.  Otherwise its text is cut before every object that begins with a
    declared field: in a string of valid JSON the quote of such a beginning would be escaped, so no good element is
    cut; pieces are then parsed one by one, and what the damage touches is all that is lost.  A file is one row, as for
    any reader of JSON arrays; land large snapshots as many files.
    """
    schema = raw_schema(entity)
    names = {column: field for field, column in (field_aliases or {}).items()}
    fields = [(f.name, names.get(f.name, f.name), f.dataType.simpleString()) for f in schema.fields]
    start = "|".join(re.escape(field) for _, field, _ in fields)
    files = spark.read.text(landing_path(root, entity, snapshot), wholetext=True).select(
        "value", F.col("_metadata.file_path").alias("file"))
    # Patterns that begin with blanks are tried at every character, so blanks and brackets go from the pieces, not the text.
    cut = F.split("value", rf',\s*(?=\{{\s*"(?:{start})"\s*:)')
    parts = files.select("file", F.when(F.try_parse_json("value").isNotNull(), F.array("value")).otherwise(cut).alias("parts"))
    # There is always a part; without "outer" Spark would compute them twice, to look for files without any.
    pieces = parts.select("file", F.size("parts").alias("n"), F.posexplode_outer("parts").alias("position", "piece"))
    first, last, piece = F.col("position") == 0, F.col("position") == F.col("n") - 1, F.col("piece")
    piece = F.when(first, F.regexp_replace(piece, r"^\s*\[", "")).otherwise(piece)
    piece = F.when(last, F.regexp_replace(piece, r"\]\s*$", "")).otherwise(piece)
    pieces = pieces.select("file", "position", piece.alias("piece"), last.alias("last"))
    # A piece may hold several elements (a whole file does), so it is parsed as an array.
    pieces = pieces.filter(F.when(F.col("last"), F.length(F.trim("piece")) > 0).otherwise(F.col("piece").rlike(r"\S"))).withColumn(
        "document", F.try_parse_json(F.concat(F.lit("["), "piece", F.lit("]"))))
    found = pieces.lateralJoin(spark.tvf.variant_explode_outer(F.col("document").outer()))
    value = F.col("value")
    typed = {name: F.try_variant_get(value, f"$['{field}']", kind) for name, field, kind in fields}
    unfit = F.lit(False)
    for name, field, kind in fields:
        if kind != "string":
            unfit = unfit | (typed[name].isNull() & F.try_variant_get(value, f"$['{field}']", "string").isNotNull())
    # Only an object is a struct, if one without fields.
    good = F.try_variant_get(value, "$", "struct<>").isNotNull() & ~unfit
    text = F.coalesce(value.cast("string"), F.when(F.col("last"), F.col("piece")).otherwise(F.rtrim("piece", F.lit(" \t\n\x0b\f\r"))))
    return found.select(
        *(F.when(good, column).alias(name) for name, column in typed.items()), "file",
        (F.col("position") + F.coalesce("pos", F.lit(0))).alias("position"), F.when(~F.coalesce(good, F.lit(False)), text).alias(CORRUPT))


def corrupt_array_split(elements: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of good elements, bad elements with file and position) of :func:`array_elements`."""
    good = elements.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "file", "position")
    return good, elements.filter(F.col(CORRUPT).isNotNull()).select("file", "position", CORRUPT)


def write_raw_lines(df: DataFrame, path: str, compression: str = "none") -> str:
    """Land rows as JSON lines, NULL fields included as absent."""
    df.write.mode("overwrite").option("compression", compression).json(path)
    return path


def write_raw_arrays(df: DataFrame, path: str, rows_per_file: int = 100_000, elements: Column | None = None) -> str:
    """Land rows as gzipped JSON-array files of at most ``rows_per_file`` rows; ``elements`` overrides their text.

    Every task cuts its own rows into arrays, so nothing is shuffled or grouped
    and a repeated task writes the same rows again.
    """
    text = F.to_json(F.struct(*df.columns)) if elements is None else elements
    _arrays(df.select(F.lit("").alias("folder"), text.alias("value")), rows_per_file).select("value").write.mode("overwrite").option(
        "maxRecordsPerFile", 1).option("compression", LANDED).text(path)
    return path


def write_raw_folders(
    df: DataFrame, by: str, paths: Mapping[str, Mapping[str, int]], rows_per_file: int = 100_000, elements: Column | None = None
) -> None:
    """:func:`write_raw_arrays` for many folders in one pass over ``df``.

    ``paths`` has, per value of the text column ``by``, the folders its rows go to and how often.  They are written beside the first of
    them and renamed, so every folder is new; one whose rows are none is empty.
    """
    spark, text = df.sparkSession, F.to_json(F.struct(*df.columns)) if elements is None else elements
    folders = sorted({path for some in paths.values() for path in some})
    targets = F.create_map(*(part for value, some in paths.items() for part in (
        F.lit(value), F.array(*(F.lit(f"f{folders.index(path)}") for path, times in some.items() for _ in range(times))))))
    rows = df.select(F.try_element_at(targets, F.col(by)).alias("folders"), text.alias("value"))
    rows = rows.select(F.explode("folders").alias("folder"), "value")
    staged = f"{folders[0]}-{uuid.uuid4().hex}"
    _arrays(rows, rows_per_file).write.partitionBy("folder").option("maxRecordsPerFile", 1).option("compression", LANDED).text(staged)
    at = spark._jvm.org.apache.hadoop.fs.Path
    fs = at(staged).getFileSystem(spark._jsc.hadoopConfiguration())
    for i, path in enumerate(folders):
        if fs.exists(at(path)):
            raise FileExistsError(path)
        source = at(f"{staged}/folder=f{i}")
        fs.mkdirs(at(path).getParent())
        if not (fs.rename(source, at(path)) if fs.exists(source) else fs.mkdirs(at(path))):
            raise OSError(f"{path} could not be written")
    fs.delete(at(staged), True)


def _arrays(df: DataFrame, rows_per_file: int) -> DataFrame:
    """(folder, value): a JSON array of at most ``rows_per_file`` elements in a row, from (folder, value) with one."""

    # Self-contained: workers need no copy of this package.
    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.Array]] = {}
        counts: dict[str, int] = {}

        def document(folder: str, rows: pa.Array) -> pa.RecordBatch:
            if rows.null_count:
                raise TypeError("an element has no text")
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows), ",")[0].as_py()
            return pa.RecordBatch.from_pydict({"folder": [folder], "value": [f"[{joined}]"]})

        for batch in batches:
            folders, values = batch.column(0), batch.column(1).cast(pa.string())
            for folder in folders.unique().to_pylist():
                rows = values.filter(pc.equal(folders, folder))
                held.setdefault(folder, []).append(rows)
                counts[folder] = counts.get(folder, 0) + len(rows)
                if counts[folder] >= rows_per_file:
                    rows = pa.concat_arrays(held[folder])
                    while len(rows) >= rows_per_file:
                        yield document(folder, rows.slice(0, rows_per_file))
                        rows = rows.slice(rows_per_file)
                    held[folder], counts[folder] = [rows], len(rows)
        for folder, rest in held.items():
            if counts[folder]:
                yield document(folder, pa.concat_arrays(rest))

    return df.mapInArrow(arrays, "folder string, value string")
