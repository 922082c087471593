"""Raw newline-delimited JSON input.

With no schema, Spark infers one in an extra pass over the files (the
default). At scale, pass the declared schema from :data:`RAW_SCHEMAS`:
the scan then reads the files once. Declared columns that are absent from a
file come back NULL; malformed lines land in ``_corrupt_record`` either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The raw dumps' file names (the public dataset's naming) and
# the datasets in load order.
# ---------------------------------------------------------------------------
RAW_FILE = "yelp_academic_dataset_{name}.json"
DATASETS = ("business", "review", "user", "checkin", "tip")

CORRUPT = "_corrupt_record"
RESCUED = "_rescued"  # keys that the declared schema does not list, with their values as text

# Declared raw schemas: every published column, all as string. A string column
# takes whatever JSON value stands there (a quoted number, 3.0 in an integer
# field, a nested object as its JSON text); silver casts. Keys that are not
# listed go to RESCUED when read by read_declared.
_COMPLIMENTS = "hot more profile cute list note plain cool funny writer photos"
_COLUMNS = {
    "business": "business_id name address city state postal_code latitude longitude stars review_count is_open attributes categories hours",
    "review": "review_id user_id business_id stars useful funny cool text date",
    "checkin": "business_id date",
    "user": "user_id name review_count yelping_since useful funny cool elite friends fans average_stars "
    + " ".join(f"compliment_{c}" for c in _COMPLIMENTS.split()),
    "tip": "user_id business_id text date compliment_count",
}
RAW_SCHEMAS: dict[str, str] = {
    name: ", ".join(f"{c} string" for c in [*columns.split(), CORRUPT]) for name, columns in _COLUMNS.items()
}


def raw_path(raw_dir: str, name: str, pattern: str = RAW_FILE) -> str:
    return f"{raw_dir.rstrip('/')}/{pattern.format(name=name)}"


def read_raw(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Permissive JSON scan; ``schema=None`` infers it (one extra pass)."""
    reader = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def declared_fields(schema: str) -> T.StructType:
    """The schema's columns without the corrupt-record column."""
    return T.StructType([f for f in T.StructType.fromDDL(schema).fields if f.name != CORRUPT])


def parse_lines(lines: DataFrame, schema: str) -> DataFrame:
    """Columns of the JSON lines in ``value``: the schema's, ``_corrupt_record`` and ``_rescued``.

    A line that is no JSON object is kept whole in ``_corrupt_record``, with
    all else null. ``_rescued`` maps keys outside of the schema to their
    values as text; it is null, not empty, without such keys, and only lines
    that have some are parsed for it. Names match by case. The record is a
    column of its own first, so that a line is parsed once and not for each field.
    """
    fields = declared_fields(schema)
    line, known = F.col("value"), F.array(*[F.lit(f.name) for f in fields])
    keys, record = F.col("__keys"), F.col("__record")
    keyed = lines.select("value", F.json_object_keys(line).alias("__keys"))
    parsed = keyed.select("value", "__keys", F.when(keys.isNotNull(), F.from_json(line, fields)).alias("__record"))
    values = F.from_json(line, T.MapType(T.StringType(), T.StringType()))
    others = F.map_filter(values, lambda k, v: ~F.array_contains(known, k))
    return parsed.select(
        *[record.getField(f.name).alias(f.name) for f in fields],
        F.when(keys.isNull(), line).alias(CORRUPT),
        F.when(F.size(F.array_except(keys, known)) > 0, others).alias(RESCUED),
    )


def read_declared(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One scan of the lines by a declared schema that loses no key: see :func:`parse_lines`. Blank lines are no rows."""
    lines = spark.read.text(path)
    return parse_lines(lines.where(F.btrim("value", F.lit(" \t\r\n")) != ""), schema)


PACKED_ROWS = 500_000  # rows in a compressed file, which only one task can read: 40 to 120 MB of text from these tables
PACKED = (".gz", ".deflate", ".bz2", ".lz4", ".snappy", ".zst")
PACKED_SHRINK = 8  # bytes of JSON text per compressed byte; 6 to 10 of the large dumps by gzip


def write_raw(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Write rows as newline-delimited JSON (NULL fields are omitted, as in the dumps), compressed if asked for."""
    writer = df.write.mode("overwrite")
    if compression is not None:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", PACKED_ROWS)
    writer.json(path)


def packed(spark: SparkSession, path: str) -> bool:
    """Whether the dump's files are compressed, by their names (a listing, no data read; False if it cannot be had)."""
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        names = [s.getPath().getName() for top in fs.globStatus(p) or [] for s in (fs.listStatus(top.getPath()) if top.isDirectory() else [top])]
    except Exception:  # noqa: BLE001 - it only decides how the dump is split
        return False
    return any(n.endswith(PACKED) for n in names)
