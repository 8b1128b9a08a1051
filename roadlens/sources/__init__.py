"""Loaders for the vehicle-log data model, text lines and ego lists, the
stream reader, and the role bindings that map the driver tables onto them.

Loaders are declarative (``spark.read`` with explicit schemas); projections
and filters applied later are pushed into the parquet / CSV scans by
Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from roadlens import schemas as S
from roadlens.functions import java_split, monitor_of_props, parse_log_time, whole_number


# --------------------------------------------------------------------------
# files in the original layouts
# --------------------------------------------------------------------------
def load_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def parse_tsv(lines: DataFrame, schema, mode: str = "DROPMALFORMED", text_col: str = "value") -> DataFrame:
    """TAB-separated lines split like Java ``String.split`` into exactly
    ``len(schema)`` fields, cast to the schema.  ``DROPMALFORMED`` drops
    lines with another field count or a non-numeric number field;
    ``FAILFAST`` raises on them."""
    if mode not in ("DROPMALFORMED", "FAILFAST"):
        raise ValueError(f"mode must be DROPMALFORMED or FAILFAST, not {mode!r}")
    n = len(schema.fields)
    p = java_split(F.col(text_col), "\t")
    fields = [F.get("p", F.lit(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]
    ok = F.size("p") == n
    for i, f in enumerate(schema.fields):
        if f.dataType.typeName() != "string":
            ok = ok & F.get("p", F.lit(i)).try_cast(f.dataType).isNotNull()
    ok = F.coalesce(ok, F.lit(False))
    rows = lines.select(F.col(text_col).alias("value"), p.alias("p"))
    if mode == "DROPMALFORMED":
        rows = rows.where(ok)
    else:
        rows = rows.where(ok | F.raise_error(F.concat(F.lit("malformed line: "), F.col("value"))).isNull())
    return rows.select(*fields)


#: Why a line is no record (``reason`` of :func:`classify_tsv`).
WRONG_FIELDS, WRONG_NUMBER, NO_LINE = "fields", "number", "null"


def classify_tsv(lines: DataFrame, schema, text_col: str = "value") -> DataFrame:
    """Every line, with the fields of ``schema`` and a ``reason``: NULL for a
    record, ``fields`` for another number of fields, ``number`` for a field that
    is not of its type, ``null`` for no text.  The line itself is ``value``;
    the fields of a rejected line are NULL.  :func:`parse_tsv` keeps exactly
    the lines without a reason."""
    p, names = java_split(F.col(text_col), "\t"), [f.name for f in schema.fields]
    rows = lines.select(F.col(text_col).alias("_line"), p.alias("_p"))
    made = [F.get("_p", F.lit(i)).try_cast(f.dataType) for i, f in enumerate(schema.fields)]
    typed = [m for m, f in zip(made, schema.fields) if f.dataType.typeName() != "string"]
    bad = F.lit(False)
    for m in typed:
        bad = bad | m.isNull()
    reason = (F.when(F.col("_line").isNull(), NO_LINE).when(F.size("_p") != len(names), WRONG_FIELDS).when(bad, WRONG_NUMBER))
    rows = rows.withColumn("reason", reason)
    ok = F.col("reason").isNull()
    return rows.select(F.col("_line").alias("value"), "reason", *[F.when(ok, m).alias(n) for m, n in zip(made, names)])


def split_lines(lines: DataFrame, schema, path: str, text_col: str = "value") -> tuple[DataFrame, DataFrame, dict]:
    """Writes records and rejected lines in one pass over the input, below
    ``path``, and returns ``(records, rejected, counts)``: the records with the
    fields of ``schema``, the rejected lines as ``(value, reason)``, and the
    counts observed on the way (``lines``, ``records`` and one for each reason).
    Together both outputs hold every line."""
    spark = lines.sparkSession
    seen = Observation()
    rows = classify_tsv(lines, schema, text_col)
    reasons = (WRONG_FIELDS, WRONG_NUMBER, NO_LINE)
    rows = rows.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(F.col("reason").isNull()).alias("records"),
                        *[F.count_if(F.col("reason") == r).alias(r) for r in reasons])
    # a record's line is told by its fields; only rejected ones keep their text
    out = rows.select(F.when(F.col("reason").isNotNull(), F.col("value")).alias("value"), "reason",
                      *[f.name for f in schema.fields], F.coalesce("reason", F.lit("record")).alias("outcome"))
    out.write.partitionBy("outcome").parquet(path)
    whole = spark.read.schema(out.schema).parquet(path)
    return (whole.where("outcome = 'record'").select(*[f.name for f in schema.fields]),
            whole.where("outcome <> 'record'").select("value", "reason"), seen.get)


def parse_vehicle_log(lines: DataFrame, mode: str = "DROPMALFORMED", text_col: str = "value") -> DataFrame:
    """Vehicle-log lines (see :func:`load_vehicle_log`) as rows, with
    ``event_time`` parsed from ``dateTime``."""
    return parse_tsv(lines, S.VEHICLE_LOG, mode, text_col).withColumn("event_time", parse_log_time(S.DATE_TIME))


def load_vehicle_log(spark: SparkSession, path: str, mode: str = "DROPMALFORMED",
                     view: str | None = S.LOG_VIEW) -> DataFrame:
    """TSV vehicle log without header: dateTime, vehiclePlate, vehicleSpeed,
    roadId, monitorId, cameraId.  ``mode='DROPMALFORMED'`` drops lines that
    do not have six fields (the in-memory path of the original), ``'FAILFAST'``
    raises (its file path).  Adds ``event_time`` parsed from ``dateTime``."""
    df = parse_vehicle_log(spark.read.text(path), mode)
    if view:
        df.createOrReplaceTempView(view)
    return df


def load_relationship(spark: SparkSession, path: str, mode: str = "DROPMALFORMED",
                      view: str | None = S.RELATIONSHIP_VIEW) -> DataFrame:
    """TSV road -> monitor -> camera dimension (roadId, monitorId, cameraId)."""
    df = parse_tsv(spark.read.text(path), S.RELATIONSHIP, mode)
    if view:
        df.createOrReplaceTempView(view)
    return df


def ego_lists(lines: DataFrame, sep: str = " ", text_col: str = "value") -> DataFrame:
    """Ego lists ``person friend1 friend2 ...`` -> long form
    ``(ego_id, head, member)``, one row per distinct friend of a line.

    ``ego_id`` identifies the line (pairs are only formed inside one line):
    a hash of the text and of the number of the copy, where a line occurs
    several times.  So it does not depend on how the lines are read, and a
    task that runs again gives the same ids.
    """
    copies = (lines.groupBy(F.col(text_col).alias("line")).agg(F.count(F.lit(1)).alias("n"))
              .select("line", F.explode(F.expr("sequence(1, n)")).alias("copy")))
    parts = (copies.select(F.xxhash64("line", "copy").alias("ego_id"), java_split(F.col("line"), sep).alias("p"))
             .where(F.size("p") > 0))
    return (parts.select("ego_id", F.col("p")[0].alias("head"),
                         F.explode(F.array_distinct(F.slice("p", 2, 1 << 30))).alias("member")))


def read_stream(spark: SparkSession, fmt: str, options: dict | None = None,
                schema=None, path: str | None = None) -> DataFrame:
    """Thin ``readStream`` front: ``fmt`` is ``kafka``, ``parquet``, ``text``,
    ``rate``...  For Kafka the value is cast to a string column ``value``."""
    r = spark.readStream.format(fmt).options(**(options or {}))
    if schema is not None:
        r = r.schema(schema)
    df = r.load(path) if path else r.load()
    if fmt == "kafka":
        df = df.select(F.col("key").cast("string"), F.col("value").cast("string"),
                       F.col("timestamp"))
    return df


def parse_stream_log(lines: DataFrame, value_col: str = "value",
                     ingest_time: bool = False) -> DataFrame:
    """Parse live log lines (TAB separated, time ``yyyy-MM-dd HH:mm:ss``);
    drop the dirty ``ILLEGAL_LOG`` records and lines whose speed is not an
    integer.  Fields that a short line lacks are NULL; a line without a speed
    is dropped, never an error.  ``ingest_time`` stamps processing time
    instead of field 0."""
    v = F.col(value_col)
    p = java_split(v, "\t")
    df = (lines.where(v != F.lit(S.ILLEGAL_LOG))
          .select(p.alias("p"), *([F.current_timestamp().alias("_ingest")] if ingest_time else [])))
    field = lambda i: F.get("p", F.lit(i))
    t = F.col("_ingest") if ingest_time else F.try_to_timestamp(field(0), F.lit(S.STREAM_TIME_FORMAT))
    return (df.select(t.alias("event_time"),
                      field(1).alias(S.PLATE),
                      field(2).try_cast("int").alias(S.SPEED),
                      field(3).alias(S.ROAD),
                      field(4).alias(S.MONITOR),
                      field(5).alias(S.CAMERA))
            .where(F.col(S.SPEED).isNotNull()))


def log_as_lines(log: DataFrame, time_format: str) -> DataFrame:
    """The log rendered as TAB-separated lines, column ``value``: time, plate,
    whole speed, road (always ``-``), monitor, camera; missing values are
    empty."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return log.select(F.concat_ws("\t", text(F.date_format("event_time", time_format)), text(F.col(S.PLATE)),
                                  text(whole_number(S.SPEED)), F.lit("-"), text(F.col(S.MONITOR)),
                                  text(F.col(S.CAMERA))).alias("value"))


# --------------------------------------------------------------------------
# role bindings on the driver tables
# --------------------------------------------------------------------------
def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_as_log(events: DataFrame) -> DataFrame:
    """``events`` in the vehicle-log roles: event_time = ts, vehiclePlate =
    user_id, vehicleSpeed = value, monitorId = props.k, cameraId =
    event_type; event_id is kept as the unique tie-breaker."""
    return events.select(
        F.col("ts").alias("event_time"),
        F.col("user_id").alias(S.PLATE),
        F.col("value").alias(S.SPEED),
        monitor_of_props("props").alias(S.MONITOR),
        F.col("event_type").alias(S.CAMERA),
        F.col("event_id"))


def _spread(df: DataFrame, partitions: int | None) -> DataFrame:
    return df if partitions is None else df.repartition(partitions)


def vehicle_log(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """``events`` as the vehicle log.  ``partitions`` deals the projected rows
    out anew, for a caller who knows that the file cannot be split and that
    much work per row follows; by default nothing is shuffled."""
    return _spread(events_as_log(_table(spark, sf_dir, "events")), partitions)


def document_lines(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Every line of every document (split on ``\\n`` like a text-file read),
    column ``value``; ``partitions`` as in :func:`vehicle_log`."""
    docs = _spread(_table(spark, sf_dir, "documents").select("text"), partitions)
    return docs.select(F.explode(java_split(F.col("text"), "\n")).alias("value"))


def order_cameras(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(declared, log)`` of devices: every order is a declared camera of its
    customer (the monitor), and every line item is a reading of its order's
    camera.  An order without lines is a camera that never reported."""
    orders = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias(S.MONITOR), F.col("o_orderkey").alias(S.CAMERA))
    lines = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias(S.CAMERA))
    return orders, lines.join(orders, S.CAMERA).select(S.MONITOR, S.CAMERA)


# the order that makes lines of one order a sequence of parts; lines that are equal here have the same part, so
# no further column changes the sequence
PART_EDGE_ORDER = ["l_linenumber", "l_partkey"]
# line numbers that one task orders at a time
LINE_BUCKET = 64
# tasks over the ego lists for each that reads lineitem: they write many times what they read
EGO_TASKS = 8


def part_ego_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relationship data from ``lineitem``: two parts are friends when they
    are consecutive lines of one order; the ego list of a part is the part
    with all its friends.  Long form ``(ego_id, head, member)`` with
    ``ego_id = head``, so every friendship appears in both ego lists.  The
    rows of a list lie in one partition."""
    from roadlens.plans.sequence import ordered_steps

    li = _table(spark, sf_dir, "lineitem").select("l_orderkey", *PART_EDGE_ORDER)
    bucket = F.floor(F.col("l_linenumber") / LINE_BUCKET)
    seq = ordered_steps(li, "l_orderkey", PART_EDGE_ORDER, ["l_partkey"], bucket)
    nxt = F.col("next1_l_partkey")
    ends = (("l_partkey", "next1_l_partkey"), ("next1_l_partkey", "l_partkey"))
    edges = (seq.where(nxt.isNotNull() & (nxt != F.col("l_partkey")))
             .select(F.explode(F.array(*[F.struct(F.col(x).alias("head"), F.col(y).alias("member")) for x, y in ends])).alias("e"))
             .select("e.head", "e.member"))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), EGO_TASKS * li.rdd.getNumPartitions())
    edges = edges.where(F.col("head").isNotNull()).repartition(n, "head").distinct()
    return edges.select(F.col("head").alias("ego_id"), "head", "member")
