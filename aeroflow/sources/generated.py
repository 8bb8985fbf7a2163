"""Topics derived from the given tables, for tests and registered queries.

Every order becomes a flight, 100 to a page; every supplier an airport whose
frequencies and runways are its lineitems. Absent fields, bad timestamps and
repeated sends are put in on purpose.

No message may grow with the data. A page or airport that has more rows than
fit is sent as several messages, as a paged API would do, so one key holding a
third of all rows becomes many messages of bounded size, not one huge message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FLIGHTS_PER_MESSAGE = 100
CHILDREN_PER_MESSAGE = 500
PARTITIONS = 3

# Rows that become documents in one task. A shuffle is cut by the bytes of its narrow rows, which
# are a thirtieth of their documents', so tasks are counted by rows: their sorts then fit in memory.
FLIGHTS_PER_TASK = 50_000
CHILDREN_PER_TASK = 250_000
STRAYS_PER_TASK = 50_000

FLIGHTS_TOPIC = "flights"
AIRPORTS_TOPIC = "airports"
STRAY_TOPIC = "strays"

# Offsets rise with the wave a message is sent in: first pages, then later
# pages, then repeats. They are unique within a partition but not gap-free, as
# in a compacted topic, so no global numbering of the messages is needed.
WAVE = 2**32
RESEND_WAVE = 2**30
FIRST_SEND = 1_735_689_600


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks(rows: DataFrame, per_task: int) -> int:
    """How many tasks make documents of stored rows; only the files' footers are read."""
    spark = rows.sparkSession
    return max(spark.sparkContext.defaultParallelism, -(-rows.count() // per_task))


def page_counts(rows: DataFrame, key: str, rows_per_page: int) -> DataFrame:
    """The pages that the rows of each key fill."""
    return rows.groupBy(key).agg(F.ceil(F.count("*") / rows_per_page).alias("pages"))


def paged(rows: DataFrame, key: str, rows_per_page: int) -> DataFrame:
    """Adds ``page``: rows of a key dealt over as many pages as they fill.

    Rows are dealt by a hash of their position in the scan, so exact copies and
    regularly spaced rows spread out too. ``rows`` must come straight from a
    file scan: then a re-run task numbers its rows the same way.
    """
    numbered = rows.withColumn("row_no", F.monotonically_increasing_id())
    pages = page_counts(rows, key, rows_per_page).where("pages > 1")
    return (
        numbered.join(pages, key, "left")
        .withColumn("page", F.coalesce(F.expr("pmod(xxhash64(row_no), pages)"), F.lit(0)))
        .drop("row_no", "pages")
    )


def _messages(docs: DataFrame, topic: str, number: str, wave: Column, key: Column) -> DataFrame:
    return docs.select(
        key.cast("binary").alias("key"),
        F.to_json("doc").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.expr(f"cast({number} % {PARTITIONS} as int)").alias("partition"),
        (wave * WAVE + F.expr(f"{number} div {PARTITIONS}")).alias("offset"),
        F.timestamp_seconds(FIRST_SEND + wave).alias("timestamp"),
    )


_ISO = "yyyy-MM-dd'T'HH:mm:ss"

_FLIGHT = f"""named_struct(
  'flight_date', date_format(o_orderdate, 'yyyy-MM-dd'),
  'flight_status', case o_orderstatus when 'F' then 'landed' when 'O' then 'scheduled' else 'active' end,
  'departure', named_struct(
    'airport', concat('Airport ', c_nationkey), 'timezone', 'Etc/UTC',
    'iata', if(c_nationkey = 0, 'JFK', concat('N', c_nationkey)),
    'icao', if(c_nationkey = 0, 'KJFK', concat('KN', c_nationkey)),
    'terminal', cast(o_orderkey % 9 as string),
    'gate', if(o_orderkey % 4 = 0, null, concat('G', o_orderkey % 30)),
    'delay', late,
    'scheduled', concat(date_format(due, "{_ISO}"), '+00:00'),
    'estimated', concat(date_format(due, "{_ISO}"), '+00:00'),
    'actual', concat(date_format(left_at, "{_ISO}"), '+00:00'),
    'estimated_runway', cast(null as string),
    'actual_runway', if(o_orderkey % 2 = 0, null, concat(date_format(left_at, "{_ISO}"), '+00:00'))),
  'arrival', named_struct(
    'airport', concat('Airport ', o_orderkey % 25), 'timezone', 'Etc/UTC',
    'iata', concat('A', o_orderkey % 25), 'icao', concat('KA', o_orderkey % 25),
    'terminal', cast(null as string), 'gate', cast(null as string),
    'baggage', if(o_orderkey % 6 = 0, concat('B', o_orderkey % 12), null),
    'scheduled', concat(date_format(due + interval 2 hours, "{_ISO}"), '+02:00'),
    'delay', if(o_orderkey % 3 = 0, null, cast(o_orderkey % 90 as int)),
    'estimated', 'not-a-timestamp',
    'actual', cast(null as string),
    'estimated_runway', cast(null as string), 'actual_runway', cast(null as string)),
  'airline', named_struct(
    'name', if(o_orderkey % 50 = 0, null, o_orderpriority),
    'iata', substr(o_orderpriority, 1, 1), 'icao', concat('AL', substr(o_orderpriority, 1, 1))),
  'flight', named_struct(
    'number', cast(o_orderkey as string),
    'iata', concat('F', o_orderkey), 'icao', concat('FL', o_orderkey),
    'codeshared', if(o_orderkey % 7 = 0, named_struct(
      'airline_name', c_mktsegment, 'airline_iata', substr(c_mktsegment, 1, 2),
      'airline_icao', substr(c_mktsegment, 1, 3), 'flight_number', cast(o_orderkey + 1 as string),
      'flight_iata', concat('C', o_orderkey), 'flight_icao', concat('CS', o_orderkey)), null)),
  'aircraft', if(o_orderkey % 11 = 0, named_struct('iata', 'B738'), null),
  'live', cast(null as string))"""


def flight_messages(
    spark: SparkSession, sf_dir: str, per_message: int = FLIGHTS_PER_MESSAGE
) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("env", F.expr("o_orderkey div 100"))
    customers = table(spark, sf_dir, "customer")
    # Plain columns are shuffled; the documents are made on the other side.
    flights = (
        paged(orders, "env", per_message)
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .repartition(tasks(orders, FLIGHTS_PER_TASK), "env", "page")
        .withColumn(
            "due",
            F.expr(
                "if(o_orderkey % 97 = 0, null,"
                " o_orderdate + make_dt_interval(0, 0, cast(o_orderkey % 1440 as int), 0))"
            ),
        )
        .withColumn("late", F.expr("if(o_orderkey % 5 = 0, null, cast(o_orderkey % 180 as int))"))
        .withColumn("left_at", F.expr("due + make_dt_interval(0, 0, late, 0)"))
        .select("env", "page", F.expr(_FLIGHT).alias("f"))
    )
    pages = flights.groupBy("env", "page").agg(F.struct(F.collect_list("f").alias("data")).alias("doc"))
    return _messages(pages, FLIGHTS_TOPIC, "env", F.col("page"), F.concat_ws("/", "env", "page"))


_FREQUENCY = """named_struct(
  '_id', concat_ws('-', l_orderkey, l_partkey, l_linenumber), 'name', l_returnflag,
  'value', cast(cast(l_extendedprice as decimal(18,2)) as string), 'unit', 2, 'type', l_linenumber,
  'primary', l_linenumber = 1, 'publicUse', l_linestatus = 'F')"""

_RUNWAY = """named_struct(
  '_id', concat_ws('-', l_orderkey, l_partkey),
  'designator', lpad(cast(cast(l_quantity as int) as string), 2, '0'),
  'pilotCtrlLighting', l_linestatus = 'F', 'takeOffOnly', l_returnflag = 'A',
  'landingOnly', l_returnflag = 'R',
  'surface', named_struct('composition', array(1, 2), 'mainComposite', cast(l_quantity as int),
    'condition', cast(null as int)),
  'dimension', named_struct('length', named_struct('value', l_quantity),
    'width', named_struct('value', if(l_tax = 0, null, l_quantity))))"""

_AIRPORT = """named_struct(
  '_id', concat('ap', s_suppkey), 'name', s_name,
  'icaoCode', if(s_suppkey % 7 = 0, null,
    if(s_suppkey = 1, 'KJFK', concat('K', lpad(cast(s_suppkey as string), 3, '0')))),
  'iataCode', if(s_suppkey % 2 = 0, null, concat('I', s_suppkey)),
  'type', cast(s_suppkey % 10 as int), 'country', n_name,
  'geometry', named_struct('type', 'Point', 'coordinates',
    array(cast((s_suppkey * 37) % 360 - 180 as double), cast((s_suppkey * 17) % 180 - 90 as double))),
  'elevation', named_struct('value', s_acctbal, 'unit', 0, 'referenceDatum', 1),
  'ppr', s_suppkey % 3 = 0, 'private', s_suppkey % 5 = 0,
  'skydiveActivity', s_suppkey % 6 = 0, 'winchOnly', false,
  'frequencies', if(s_suppkey % 9 = 0, null, frequencies),
  'runways', if(s_suppkey % 8 = 0, array(), runways))"""


def airport_messages(
    spark: SparkSession, sf_dir: str, per_message: int = CHILDREN_PER_MESSAGE
) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    airports = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    children = (
        paged(lines, "l_suppkey", per_message)
        .repartition(tasks(lines, CHILDREN_PER_TASK), "l_suppkey", "page")
        .select(
            "l_suppkey",
            "page",
            F.expr(_FREQUENCY).alias("frequency"),
            F.expr(f"if(l_linenumber = 1, {_RUNWAY}, null)").alias("runway"),
        )
        .groupBy("l_suppkey", "page")
        .agg(
            F.collect_list("frequency").alias("frequencies"),
            F.collect_list("runway").alias("runways"),
        )
    )
    # Airports come to the pages: a row for each page, sent where the page is, so that no
    # document is shuffled or sorted once more.
    last_page = (F.col("pages") - 1).alias("last_page")
    filled = page_counts(lines, "l_suppkey", per_message).select(F.col("l_suppkey").alias("served_key"), last_page)
    to_pages = airports.join(filled, F.col("s_suppkey") == F.col("served_key")).select(
        airports["*"], F.explode(F.sequence(F.lit(0).cast("bigint"), "last_page")).alias("to_page")
    )
    same_page = (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("page") == F.col("to_page"))
    with_children = children.join(to_pages.hint("shuffle_hash"), same_page)
    served = lines.select("l_suppkey").distinct()
    without = airports.join(served, F.col("l_suppkey") == F.col("s_suppkey"), "left_anti").select(
        "*",
        F.lit(0).cast("bigint").alias("page"),
        F.lit(None).cast(children.schema["frequencies"].dataType).alias("frequencies"),
        F.lit(None).cast(children.schema["runways"].dataType).alias("runways"),
    )
    docs = with_children.select(without.columns).unionByName(without)
    sends = F.expr("if(s_suppkey % 10 = 0, array(0, 1), array(0))")
    sent = docs.select(
        "s_suppkey", "page", F.expr(_AIRPORT).alias("doc"), F.explode(sends).alias("send")
    )
    wave = F.col("send") * RESEND_WAVE + F.col("page")
    return _messages(
        sent, AIRPORTS_TOPIC, "s_suppkey", wave, F.concat_ws("/", "s_suppkey", "page")
    )


def stray_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows sent to an airport job by mistake: JSON without an id, and plain words."""
    events = table(spark, sf_dir, "events")
    spread = events.select("event_id", "ts", "props", "event_type").repartition(tasks(events, STRAYS_PER_TASK), "event_id")
    return spread.withColumn("text", F.explode(F.array("props", "event_type"))).select(
        F.lit(None).cast("binary").alias("key"),
        F.col("text").cast("binary").alias("value"),
        F.lit(STRAY_TOPIC).alias("topic"),
        F.expr(f"cast(event_id % {PARTITIONS} as int)").alias("partition"),
        F.expr(f"event_id div {PARTITIONS}").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


# Messages a flight job cannot take, or not whole, by the remainder of the event's number.
BROKEN_PAGES = (
    "null",  # no value
    "'  '",
    "concat('{', props)",
    """concat('{"data":[],"of":', event_id, '}')""",
    """concat('{"data":[{"flight":{"iata":"E', event_id, '"},"flight_status":"sent"},17,{"departure":{"delay":"late"},"flight":{"iata":"F', event_id, '"}}]}')""",
    """concat('{"data":[{"flight":{"iata":"E', event_id, '"},"flight_status":"', event_type, '"}]}')""",
)


def broken_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows as flight pages: empty, malformed, without flights, with bad elements, and whole ones."""
    kind = F.col("event_id") % len(BROKEN_PAGES)
    value = F.expr("cast(null as string)")
    for i, text in enumerate(BROKEN_PAGES[1:], 1):
        value = F.when(kind == i, F.expr(text)).otherwise(value)
    return table(spark, sf_dir, "events").select(
        F.lit(None).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(STRAY_TOPIC).alias("topic"),
        F.expr(f"cast(event_id % {PARTITIONS} as int)").alias("partition"),
        F.expr(f"event_id div {PARTITIONS}").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
