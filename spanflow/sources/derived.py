"""Span logs derived from the ``lineitem`` table.

The tables at hand hold no span data, so each line item is turned into one log
event whose message is JSON text. The formulas are plain SQL that both Spark
and DuckDB read; the few words the two spell differently are parameters. Each
engine then parses the text on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EPOCH_2024 = 1704067200
LOG_GROUP = "aws/spans"
# Orders per log batch: about a thousand records, so more than one chunk of 500.
ORDERS_PER_BATCH = 256
# Events, of some 700 bytes each, that a task packs into envelopes.
ROWS_PER_PARTITION = 100_000

KEYS = {
    "k": "l_orderkey",
    "n": "cast(l_linenumber as bigint)",
    "p": "l_partkey",
    "s": "l_suppkey",
    "q": "cast(l_quantity as bigint)",
    "price": "cast(round(l_extendedprice * 100) as bigint)",
    "rf": "l_returnflag",
}


def _hex(number: str, width: int) -> str:
    return f"lpad(lower(hex({number})), {width}, '0')"


def _text(number: str) -> str:
    return f"cast({number} as string)"


def _when(condition: str, text: str, otherwise: str = "''") -> str:
    return f"case when {condition} then {text} else {otherwise} end"


def _concat(*parts: str) -> str:
    return "(" + " || ".join(parts) + ")"


TRACE_ID = _hex("k", 32)
SPAN_ID = _hex("k * 8 + n", 16)
ARRIVAL_SECONDS = f"({EPOCH_2024} + k * 30 + n * 20)"
START_NANOS = f"(({EPOCH_2024} + (k * 30 + n * 20) % 31536000) * 1000000000 + p)"


def _link(index: int, trace: str, span: str) -> str:
    kind = "parent" if index % 2 == 0 else "child"
    return _concat(
        f"""'{{"traceId":"' || {trace} || '","spanId":' || {span}""",
        f"""',"flags":{256 + index},"attributes":{{"rank":{index}}},'""",
        f"""'"_aws":{{"xray":{{"reference_type":"{kind}"}}}}}}'""",
    )


def _decorator() -> str:
    def link(index: int) -> str:
        quoted = f"""'"' || {_hex(f"s + {index % 2}", 16)} || '"'"""
        if index == 0:
            quoted = _when("q = 23", _text("s"), quoted)
        return _link(index, _hex("p", 32), f"({quoted})")

    return _concat(
        f"""'{{"resource":{{}},"traceId":"' || {TRACE_ID}""",
        f"""'","spanId":"' || {SPAN_ID} || '","name":"","kind":"INTERNAL",'""",
        """'"startTimeUnixNano":null,"endTimeUnixNano":null,"links":['""",
        link(0),
        _when("s % 3 >= 1", f"',' || {link(1)}"),
        _when("s % 3 >= 2", f"',' || {link(2)}"),
        """'],"status":{"code":"UNSET"},"_aws":{"xray":{"decorator_type":"managed_link",'""",
        _when(
            "q = 29",
            "''",
            f"""'"target_id":"' || {_hex("k * 8 + n % 7 + 1", 16)} || '",'""",
        ),
        """'"type":"decorator","reference_type":"child"}}}'""",
    )


def _span() -> str:
    resource = _concat(
        """'"resource":{"attributes":{'""",
        _when("s % 5 = 0", "''", """'"service.name":"svc-' || cast(s % 5 as string) || '",'"""),
        """'"cloud.provider":"aws","faas.name":"fn-' || cast(s % 3 as string) || '"}},'""",
    )
    scope = _when(
        "n % 4 = 3",
        "''",
        """'"scope":{"name":"scope-' || cast(n % 2 as string) || '","version":"1.' || cast(n % 3 as string) || '"},'""",
    )
    trace = (
        "case when p % 10 = 3 then "
        + _when("s % 2 = 1", """'"traceId":' || cast(k as string) || ','""")
        + f""" else '"traceId":"' || {TRACE_ID} || '",' end"""
    )
    span = _concat(
        """'"spanId":"'""",
        _when("q = 17", f"substr({SPAN_ID}, 1, 14) || 'zz'", SPAN_ID),
        """'",'""",
        _when("n > 1", f"""'"parentSpanId":"' || {_hex("k * 8 + n - 1", 16)} || '",'"""),
        _when("n % 2 = 0", """'"flags":' || cast(256 + n as string) || ','"""),
        _when("n = 5", """'"flags":4294967301,'"""),
    )
    name = """'"name":"' || """ + _when("q % 11 = 0", "''", "'op-' || cast(n as string)") + """ || '",'"""
    kind = (
        "case n % 6 when 0 then 'INTERNAL' when 1 then 'SERVER' when 2 then 'CLIENT'"
        " when 3 then 'PRODUCER' when 4 then 'CONSUMER' else 'OTHER' end"
    )
    status = "case rf when 'A' then 'OK' when 'R' then 'ERROR' else 'UNSET' end"
    end = (
        "case when p % 10 = 1 then 'null'"
        f" when q = 13 then '\"' || cast({START_NANOS} as string) || '\"'"
        " when q = 19 then '-5'"
        f" else cast({START_NANOS} + 1000000 * (1 + q) as string) end"
    )
    times = _concat(
        f"""'"kind":"' || (case when p % 2 = 1 then lower({kind}) else {kind} end) || '",'""",
        f"""'"startTimeUnixNano":' || cast({START_NANOS} as string) || ',"endTimeUnixNano":' || ({end})""",
    )
    true_or_text = _when("q = 41", "'\"true\"'", "'true'")
    attributes = _concat(
        """',"attributes":{"http.status_code":' || cast(200 + n as string)""",
        """',"http.method":"GET","nothing":null,"ok":' || """ + _when("p % 2 = 0", "'true'", "'false'"),
        """',"ratio":' || cast(q as string) || '.5'""",
        *[_when(f"q % 5 >= {i}", f"""',"x{i}":"v{i}"'""") for i in range(1, 5)],
        _when("s % 10 = 0", """',"aws.local.service":"local-' || cast(s as string) || '"'"""),
        _when("q = 37", """',"aws.xray.inprogress":true'"""),
        _when("p % 10 = 7", f"""',"aws.internal":{{"linking":' || {true_or_text} || '}}'"""),
        _when("n % 3 = 0", """',"tags":["a",' || cast(n as string) || ',{"z":[true]}]'"""),
        "'}'",
    )

    def own_link(index: int) -> str:
        quoted = f"""('"' || {_hex(f"s + {1 - index}", 16)} || '"')"""
        return _link(index, _hex("p", 32), quoted)

    links = _when(
        "s % 3 >= 1",
        _concat(
            """',"links":['""",
            own_link(0),
            _when("s % 3 >= 2", f"',' || {own_link(1)}"),
            "']'",
        ),
    )

    def event(index: int) -> str:
        return (
            f"""'{{"timeUnixNano":' || cast({START_NANOS} + {index} as string)"""
            f""" || ',"name":"ev-{index}","attributes":{{"i":{index}}}}}'"""
        )

    events = _when(
        "n % 3 >= 1 or q = 31",
        _concat(
            """',"events":['""",
            _when("q = 31", "'\"plain\"'"),
            _when("q = 31 and n % 3 >= 1", "','"),
            _when("n % 3 >= 1", event(0)),
            _when("n % 3 >= 2", f"',' || {event(1)}"),
            "']'",
        ),
    )
    state = _concat(
        f"""',"status":{{"code":"' || (case when p % 2 = 1 then lower({status}) else {status} end) || '"'""",
        _when("rf = 'R'", """',"message":"failed"'"""),
        "'}'",
    )
    xray = _when(
        "p % 10 in (4, 5, 6) or s % 2 = 0",
        _concat(
            """',"_aws":{"xray":{"type":"segment"'""",
            _when("p % 10 in (4, 5, 6)", f"""',"linking":' || {true_or_text}"""),
            _when("s % 2 = 0", """',"name":"xr-' || cast(s as string) || '"'"""),
            "'}}'",
        ),
    )
    return _concat(
        "'{'",
        _when("q = 47", SHADOWED_NAME),
        resource, scope, trace, span, name, times, attributes, links, events, state, xray,
        "'}'",
    )


# A repeated key: the later "name" wins.
SHADOWED_NAME = """'"name":"shadowed",'"""

COLUMNS = {
    "batch_id": f"cast(floor(k / {ORDERS_PER_BATCH}) as bigint)",
    "source_log_group": f"case when s % 7 = 0 then '' else '{LOG_GROUP}' end",
    "source_event_id": "'e-' || cast(k as string) || '-' || cast(n as string) || '-' || cast(p % 2 as string)",
    "trace_id": TRACE_ID,
    "span_id": SPAN_ID,
    "arrival_s": ARRIVAL_SECONDS,
    # Zero-padded, so text order is arrival order within one second.
    "arrival_seq": (
        "lpad(cast(k as string), 15, '0') || cast(n as string)"
        " || lpad(cast(p as string), 13, '0') || lpad(cast(s as string), 11, '0')"
        " || lpad(cast(q as string), 2, '0') || lpad(cast(price as string), 12, '0')"
    ),
    "message": (
        f"case when p % 10 = 2 then 'not-json' when p % 10 = 0 then {_decorator()}"
        f" else {_span()} end || case when q = 43 then ' trailing' else '' end"
    ),
}


def spread(table: DataFrame) -> DataFrame:
    """Give a table that comes in fewer pieces than there are cores one per core.

    The text made from a row is some thirty times its size, so the small row is
    what should travel. A table of many files is left as it is.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    if table.rdd.getNumPartitions() >= cores:
        return table
    return table.repartition(cores, *table.columns)


def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per log event: envelope columns, message and arrival."""
    return as_events(spread(spark.read.parquet(f"{sf_dir}/lineitem.parquet")))


def log_row_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream over the table's files: rows of which ``as_events`` makes log events, with
    their ``arrival_ts``."""
    name = "lineitem.parquet"
    schema = spark.read.parquet(f"{sf_dir}/{name}").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", name)
    table = stream.parquet(sf_dir)
    cores = spark.sparkContext.defaultParallelism
    return _keys(table.repartition(cores, *table.columns)).withColumn("arrival_ts", F.timestamp_seconds(F.expr(ARRIVAL_SECONDS)))


def _keys(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(*[f"{sql} as {name}" for name, sql in KEYS.items()])


def as_events(rows: DataFrame) -> DataFrame:
    """Log events of the table's rows, or of rows of ``log_row_stream``."""
    keys = rows if "k" in rows.columns else _keys(rows)
    return keys.selectExpr(
        "k", "n", "p", "s", "q",
        *[f"{sql} as {name}" for name, sql in COLUMNS.items()],
    ).withColumn("arrival_ts", F.timestamp_seconds("arrival_s"))


def log_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events packed into envelopes, in arrival order inside each.

    An envelope holds the events of ``ORDERS_PER_BATCH`` orders, so its size
    does not grow with the tables.
    """
    event = F.struct(
        F.col("arrival_s").alias("timestamp"),
        F.col("arrival_seq"),
        F.col("source_event_id").alias("id"),
        F.col("message"),
    )
    table = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    cores = spark.sparkContext.defaultParallelism
    # The small rows travel to their envelope, and the texts are made where they are packed.
    # A given number keeps adaptive execution from merging partitions by the rows' small size.
    parts = max(cores, -(-table.count() // ROWS_PER_PARTITION))
    keys = _keys(table).withColumn("batch_id", F.expr(COLUMNS["batch_id"])).repartition(parts, "batch_id")
    made = ["arrival_s", "arrival_seq", "source_event_id", "message"]
    return (
        keys.selectExpr("batch_id", *[f"{COLUMNS[name]} as {name}" for name in made])
        .groupBy("batch_id")
        .agg(F.array_sort(F.collect_list(event)).alias("events"))
        .select(
            "batch_id",
            F.lit(LOG_GROUP).alias("log_group"),
            F.transform(
                "events",
                lambda e: F.struct(e["id"], e["timestamp"], e["message"]),
            ).alias("log_events"),
        )
    )


def duckdb_events_sql() -> str:
    """The rows of ``log_events`` as a DuckDB query over ``lineitem``."""
    keys = ", ".join(f"{sql} as {name}" for name, sql in KEYS.items())
    columns = ", ".join(f"{sql} as {name}" for name, sql in COLUMNS.items())
    return f"select k, n, p, s, q, {columns} from (select {keys} from lineitem)"
