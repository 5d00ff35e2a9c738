"""Audit-trail JSON files -> one row per record.

Files hold ``{"Records": [...]}`` objects (one, or several, on lines of their
own or pretty-printed; optionally gzip-compressed), laid out as
``<root>/<region>/<YYYY>/<MM>/<DD>/<file>`` (the delivery layout) or the
Hive-style equivalent
``<root>/region=<r>/year=<YYYY>/month=<MM>/day=<DD>/<file>``. Region and day
come from the file path (``_metadata.file_path``), never from ``eventTime``.

Only the requested (region, day) folders are listed: the reader builds one
brace-glob over them instead of listing the whole trail root.

A file is read as one text (delivered files are small, and compressed ones
cannot be split anyway) and cut before each line that begins with ``{``; the
parts are then rows of their own, parsed one by one. The writers here keep
files small too (``FILE_RECORDS``), whatever a day holds. A part that cannot
be parsed, or holds no records, is what ``trail_quarantine`` returns, with its
raw text. Where the first part is broken and the whole file is not, the cut
was wrong (nested braces without indentation) and the whole file counts.
Records beside a broken part are kept.
"""

from __future__ import annotations

import uuid
from collections import defaultdict

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qtrail.functions.columns import day_parts
from qtrail.schemas import TRAIL, TRAIL_FILE, TRAIL_RECORD
from qtrail.sources import folders as FS

FILE_RECORDS = 5_000  # of a written file, one a line: a reader holds its whole text
FILE_OBJECTS = 500  # of a written file in the delivery layout
_PATH_RE = r"/(?:region=)?([^/]+)/(?:year=)?(\d{4})/(?:month=)?(\d{2})/(?:day=)?(\d{2})/[^/]*$"


def _alt(items) -> str:
    items = sorted(set(items))
    return items[0] if len(items) == 1 else "{" + ",".join(items) + "}"


def hive_glob(root: str, days=None, regions=None, tail: str = "") -> str | None:
    """Glob of the ``region=/day=`` folders of a Hive-layout table for the
    requested days (None when no day is requested: read the whole root)."""
    if not days:
        return None
    reg = _alt(regions) if regions else "*"
    return f"{root.rstrip('/')}/region={reg}/day={_alt(days)}{tail}"


def trail_glob(root: str, days=None, regions=None, layout: str = "native") -> str:
    """One Hadoop glob selecting exactly the requested region/day folders."""
    root = root.rstrip("/")
    hive = layout == "hive"
    reg = _alt(regions) if regions else "*"
    if hive:
        reg = "region=" + reg if regions else "region=*"
    if not days:
        tail = "year=*/month=*/day=*" if hive else "*/*/*"
        return f"{root}/{reg}/{tail}"
    by_month = defaultdict(list)
    for d in days:
        by_month[(d[:4], d[5:7])].append(d[8:10])
    parts = []
    for (y, m), dds in sorted(by_month.items()):
        dd = _alt(dds)
        parts.append(f"year={y}/month={m}/day={dd}" if hive else f"{y}/{m}/{dd}")
    return f"{root}/{reg}/{_alt(parts)}"


def empty_or_raise(spark: SparkSession, root: str, schema) -> DataFrame:
    """No folder of the requested days exists: an empty table, but only where
    the root itself does (a mistyped root must not look like no data)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        raise FileNotFoundError(f"input folder does not exist: {root}")
    return spark.createDataFrame([], schema)


_FILE = (", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TRAIL_FILE.fields) + ", _corrupt string")


def _parsed(text: str) -> str:
    return f"from_json({text}, '{_FILE}', map('mode', 'PERMISSIVE', 'columnNameOfCorruptRecord', '_corrupt'))"


# Steps from a file's text ``value`` to the texts of its parts, and from such
# a ``text`` to records, as SQL: the catalog's view of the trail is made of the
# same. Parts are parsed one row at a time, so that beside a file's text no
# more than one part's records are held.
PARTS_SQL = "filter(split(value, '[\r]?\n(?=[{])'), c -> c RLIKE '[^ \\t\\r\\n]')"
USED_SQL = (f"CASE WHEN size(parts) > 1 AND {_parsed('parts[0]')}._corrupt IS NOT NULL "
            f"AND exists(array({_parsed('value')}), w -> w._corrupt IS NULL AND w.Records IS NOT NULL) "
            "THEN array(value) ELSE parts END")
RECORDS_SQL = f"filter(coalesce({_parsed('text')}.Records, array()), r -> r IS NOT NULL)"


class BadTrailParts(ValueError):
    """More parts of trail files than allowed could not be read."""


def trail_parts(spark: SparkSession, root: str, days=None, regions=None, layout: str = "native") -> DataFrame:
    """``file, region, day, part, text``: one row per part of a file."""
    schema = "file string, region string, day string, part int, text string"
    path = trail_glob(root, days, regions, layout)
    try:
        raw = spark.read.text(path, wholetext=True)
    except AnalysisException as e:  # no folder matched: an empty day is not an error
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return empty_or_raise(spark, root, schema)
        raise
    p = F.col("_metadata.file_path")
    day = F.concat_ws("-", *[F.regexp_extract(p, _PATH_RE, i) for i in (2, 3, 4)])
    parts = raw.select(p.alias("file"), F.regexp_extract(p, _PATH_RE, 1).alias("region"), day.alias("day"), "value",
                       F.expr(PARTS_SQL).alias("parts"))
    return parts.select("file", "region", "day", F.posexplode(F.expr(USED_SQL)).alias("part", "text"))


def read_trail(spark: SparkSession, root: str, days=None, regions=None, layout: str = "native") -> DataFrame:
    """Trail records with ``region`` and ``day`` ('YYYY-MM-DD') columns."""
    parts = trail_parts(spark, root, days, regions, layout)
    rec = parts.select("region", "day", F.explode(F.expr(RECORDS_SQL)).alias("r"))
    return rec.select(*[F.col(f"r.{f.name}").alias(f.name) for f in TRAIL_RECORD.fields], "region", "day")


def trail_quarantine(spark: SparkSession, root: str, days=None, regions=None, layout: str = "native") -> DataFrame:
    """``file, region, day, part, reason, text`` of the parts that do not
    parse (``corrupt``) or hold no ``Records`` (``no_records``)."""
    parts = trail_parts(spark, root, days, regions, layout)
    # exploded, not a column: a part is parsed once
    reasons = (f"transform(array({_parsed('text')}), f -> CASE WHEN f._corrupt IS NOT NULL OR f IS NULL THEN 'corrupt' "
               "WHEN f.Records IS NULL THEN 'no_records' END)")
    return (parts.select("file", "region", "day", "part", F.explode(F.expr(reasons)).alias("reason"), "text")
            .where(F.col("reason").isNotNull()))


def set_aside(spark: SparkSession, root: str, target: str, days=None, regions=None, layout: str = "native",
              most: int | None = None) -> int:
    """Write the quarantine of these days to a new folder ``target`` and
    return its rows; more than ``most`` of them fail the job."""
    trail_quarantine(spark, root, days, regions, layout).write.mode("error").option("compression", "gzip").json(target)
    kept = spark.read.schema("file string, reason string").json(target)
    n = kept.count()
    if most is not None and n > most:
        sample = [f"{r['file']} ({r['reason']})" for r in kept.orderBy("file").limit(5).collect()]
        raise BadTrailParts(f"{n} unreadable parts of trail files, {most} allowed; see {target}: {', '.join(sample)}")
    return n


def write_trail(df: DataFrame, root: str, mode: str = "overwrite", compression: str = "gzip") -> None:
    """Write trail rows (schema ``TRAIL``) as JSON lines in the Hive-style
    layout, one record per ``Records`` array so no group is ever collected."""
    rec = F.array(F.struct(*[F.col(f.name) for f in TRAIL_RECORD.fields]))
    y, m, d = day_parts("day")
    out = df.select(rec.alias("Records"), "region", y.alias("year"), m.alias("month"), d.alias("day"))
    parts = ("region", "year", "month", "day")
    (out.hint("rebalance", *parts).write.mode(mode).option("compression", compression)
        .option("maxRecordsPerFile", FILE_RECORDS).partitionBy(*parts).json(root))


def write_trail_delivery(df: DataFrame, root: str, per_object: int = 50) -> None:
    """Write trail rows as they are delivered: gzip files of ``Records``
    objects with up to ``per_object`` records each, under
    ``<root>/<region>/YYYY/MM/DD``. Rows that stand together in the input make
    an object, so no group grows with the data."""
    spark = df.sparkSession
    names = ("region", "year", "month", "day")
    y, m, d = day_parts("day")
    rows = df.select(F.struct(*[F.col(f.name) for f in TRAIL_RECORD.fields]).alias("r"), "region", y.alias("year"),
                     m.alias("month"), d.alias("day"),
                     F.floor(F.monotonically_increasing_id() / per_object).alias("_object"))
    objects = rows.groupBy(*names, "_object").agg(F.collect_list("r").alias("Records")).drop("_object")
    version = f"{root.rstrip('/')}/_version/{uuid.uuid4().hex}"
    (objects.hint("rebalance", *names).write.mode("error").option("compression", "gzip")
     .option("maxRecordsPerFile", FILE_OBJECTS).partitionBy(*names).json(version))
    for path in FS.matching(spark, "/".join([version, *(f"{k}=*" for k in names)])):
        FS.move(spark, path, "/".join([root.rstrip("/"), *FS.partition_values(path, names)]))
    FS.delete(spark, [version])
