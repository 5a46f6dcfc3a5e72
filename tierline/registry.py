"""Registered queries: one per operator of the inventory, each with an oracle.

Every query reads the driver's tables in full (through the adapters of
:mod:`tierline.testbed`) and returns a DataFrame; the matching SQL computes
the same result in an independent engine from the same tables. Streaming
queries run their stream to completion in fresh folders under the session's
shared scratch root and return a batch read of what the sink committed.
Values that vary per run (arrival stamps) are returned as ``has_*`` flags.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .functions.rule_table import with_rule_table
from .functions.timefmt import epoch_seconds, iso_text
from .functions.triage import (
    DEFAULT_OUTCOME,
    DEFAULT_RULES,
    FRICTION,
    HARDWARE,
    Outcome,
    Rule,
    parse_triage_json,
    to_triage_json,
    with_triage,
)
from .functions.picks import lehmer_sql
from .operators import gold as gold_ops
from .operators.columns import drop_columns, parse_timestamp, stamp
from .operators.enrich import left_enrich
from .operators.fingerprint import same_rows
from .operators.keys import key_rejects, require_key
from .plans.bronze import run_bronze
from .plans.chain import ChainPaths, run_chain
from .plans.gold import UPSERT_BROADCAST_ROWS, merge_into_target, run_gold_incremental
from .plans.silver import run_silver_events, run_silver_tickets
from .schemas import CORRUPT, GOLD_DEFAULTS, GOLD_KEY, GOLD_TARGET, RAW_EVENT, TICKET
from .session import materialize, scratch_path, use_utc
from .sinks.landing import landing_arrays, write_landing_files
from .sinks.snapshots import evolve
from .sinks.target import merge_target, read_target, replace_target
from .sources.files import (
    event_json_stream,
    landing_json_stream,
    read_json_batch,
    read_parquet_guarded,
)
from .sources.synthetic import (
    CUSTOMER_HIGH,
    CUSTOMER_LOW,
    CUSTOMER_PREFIX,
    PRODUCTS,
    SALT_CUSTOMER,
    SALT_PRODUCT,
    TEXT_PARTS,
    TICKET_PREFIX,
    tickets_from_rows,
)
from .streaming.compact import run_compaction
from .streaming.enrich import enrich_each_batch
from .streaming.runner import batch_count, batches_with_input, run_available_now
from .testbed import (
    DIMENSION_COLUMNS,
    DOC_TICKETS_SQL,
    ISO_MICROS_SQL,
    ISO_SECONDS_SQL,
    LABELED_TICKETS_SQL,
    LINE_TICKETS_SQL,
    RAW_EVENTS_SQL,
    TICKET_COLUMNS,
    USER_DIMENSION_SQL,
    doc_tickets,
    doc_tickets_sql,
    labeled_tickets,
    line_tickets,
    raw_events,
    table,
    user_dimension,
)

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}

# Rules for the documents: the default keywords hardly occur in the invented
# prose, so the ticket queries use a rule list that does fire on it (rules are
# an argument of every triage operator).
TEXT_RULES = (
    Rule(("dies", "broke"), HARDWARE),
    Rule(("ment", "ung"), FRICTION),
)

# Landed feeds: at least this many files, however small the table; beyond
# that, files are filled up to the landing writer's byte bound.
LANDING_PARTS = 8
# Records of a landing file of the feed that bronze turns into many small files.
SMALL_FILE_RECORDS = 320
# Micro-batches that a rate-limited drain takes, whatever the number of files.
DRAIN_BATCHES = 4

# Upsert scenario: three loads by shipping date, applied in order.
LOAD_BORDERS = ("1996-01-01", "2001-06-01")


def register(name: str, sql: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_utc(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        run.__wrapped__ = fn
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return wrap


def ntz(name: str):
    return F.col(name).cast("timestamp_ntz").alias(name)


def _sql_text(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def triage_sql(text: str, rules: tuple[Rule, ...], default: Outcome) -> dict[str, str]:
    """CASE expressions (one per triage field) for the oracle engine."""
    out = {}
    for field in ("sentiment", "urgency_score", "summary"):
        parts = [f"case when {text} is null then null"]
        for rule in rules:
            cond = " or ".join(f"contains(lower({text}), {_sql_text(k.lower())})" for k in rule.keywords)
            parts.append(f"when {cond} then {_sql_text(getattr(rule.outcome, field))}")
        parts.append(f"else {_sql_text(getattr(default, field))} end")
        out[field] = " ".join(parts)
    return out


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join(_sql_text(v) for v in values) + "]"


# ====================================================================== gold
@register("gold_product_metrics", f"""
    select product_id, count(ticket_id) as total_reviews, avg(urgency_score) as avg_urgency
    from ({LINE_TICKETS_SQL}) t group by product_id""")
def gold_product_metrics(spark, sf):
    """A1-A3 at scale: per part, count of order lines and mean quantity."""
    return gold_ops.product_metrics(line_tickets(spark, sf))


@register("gold_labeled_metrics", f"""
    select product_id, count(ticket_id) as total_reviews, avg(urgency_score) as avg_urgency
    from ({LABELED_TICKETS_SQL}) t group by product_id""")
def gold_labeled_metrics(spark, sf):
    """A1-A3 with partial labels: unlabeled tickets count but add no urgency."""
    return gold_ops.product_metrics(labeled_tickets(spark, sf))


@register("gold_sentiment_counts", f"""
    select product_id,
           count(*) filter (where sentiment = 'Negative') as negative_ticket_count,
           count(*) filter (where sentiment = 'Positive') as positive_ticket_count
    from ({LABELED_TICKETS_SQL}) t group by product_id""")
def gold_sentiment_counts(spark, sf):
    """A4: negative and positive ticket counts per product."""
    return gold_ops.sentiment_counts(labeled_tickets(spark, sf))


@register("gold_rounded_rating", f"""
    select product_id, cast(avg(urgency_score) as decimal(4,2)) as avg_urgency_rating
    from ({LINE_TICKETS_SQL}) t group by product_id""")
def gold_rounded_rating(spark, sf):
    """A5: mean urgency rounded half-up to decimal(4,2)."""
    return gold_ops.rounded_rating(line_tickets(spark, sf))


@register("gold_staged_row", f"""
    select product_id, count(ticket_id) as total_reviews, avg(urgency_score) as avg_urgency,
           cast(avg(urgency_score) as decimal(4,2)) as avg_urgency_rating,
           count(*) filter (where sentiment = 'Negative') as negative_ticket_count,
           count(*) filter (where sentiment = 'Positive') as positive_ticket_count
    from ({LABELED_TICKETS_SQL}) t group by product_id""")
def gold_staged_row(spark, sf):
    """A1-A5 together: the full staged gold row in one aggregation."""
    return gold_ops.product_metrics(labeled_tickets(spark, sf), sentiment="sentiment", rating=True)


# ==================================================================== triage
_TK_TRIAGE = triage_sql("review_text", TEXT_RULES, DEFAULT_OUTCOME)


@register("triage_rules", f"""
    select ticket_id, {_TK_TRIAGE['sentiment']} as sentiment,
           {_TK_TRIAGE['urgency_score']} as urgency_score, {_TK_TRIAGE['summary']} as summary
    from ({DOC_TICKETS_SQL}) t""")
def triage_rules(spark, sf):
    """Ordered substring rules over every whole ticket text."""
    tk = doc_tickets(spark, sf).select("ticket_id", "review_text")
    return with_triage(tk, "review_text", rules=TEXT_RULES, flatten=True).drop("review_text")


@register("triage_json", f"""
    select ticket_id,
           case when review_text is null then null else
           cast(json_object('sentiment', {_TK_TRIAGE['sentiment']},
                            'urgency_score', {_TK_TRIAGE['urgency_score']},
                            'summary', {_TK_TRIAGE['summary']}) as varchar) end as triage_json
    from ({DOC_TICKETS_SQL}) t""")
def triage_json(spark, sf):
    """the triage result as JSON text (sentiment, urgency_score, summary)."""
    tk = doc_tickets(spark, sf).select("ticket_id", "review_text")
    t = with_triage(tk, "review_text", "triage", rules=TEXT_RULES)
    return t.select("ticket_id", to_triage_json(F.col("triage")).alias("triage_json"))


@register("triage_json_parse", f"""
    select ticket_id, {_TK_TRIAGE['sentiment']} as sentiment,
           cast({_TK_TRIAGE['urgency_score']} as double) as urgency_score,
           {_TK_TRIAGE['summary']} as summary
    from ({DOC_TICKETS_SQL}) t""")
def triage_json_parse(spark, sf):
    """JSON text back to typed columns; urgency as the double gold reads."""
    js = triage_json(spark, sf)
    parsed = js.select("ticket_id", parse_triage_json(F.col("triage_json")).alias("t"))
    return parsed.select(
        "ticket_id",
        F.col("t.sentiment").alias("sentiment"),
        F.col("t.urgency_score").cast("double").alias("urgency_score"),
        F.col("t.summary").alias("summary"),
    )


def _synthetic_sql() -> str:
    return f"""
    select '{TICKET_PREFIX}' || cast(o_orderkey as varchar) as ticket_id,
           '{CUSTOMER_PREFIX}' || cast({CUSTOMER_LOW} + ({lehmer_sql('o_orderkey', SALT_CUSTOMER)})
               % {CUSTOMER_HIGH - CUSTOMER_LOW + 1} as varchar) as customer_id,
           {_sql_list(PRODUCTS)}[1 + ({lehmer_sql('o_orderkey', SALT_PRODUCT)}) % {len(PRODUCTS)}]
               as product_id,
           {" || ' ' || ".join(f"{_sql_list(v)}[1 + ({lehmer_sql('o_orderkey', n)}) % {len(v)}]" for n, v in TEXT_PARTS)}
               as review_text,
           strftime(o_orderdate, '{ISO_SECONDS_SQL}') as "timestamp"
    from orders"""


_SYN = triage_sql("review_text", DEFAULT_RULES, DEFAULT_OUTCOME)


@register("synthetic_tickets", _synthetic_sql())
def synthetic_tickets(spark, sf):
    """One generated ticket per order, picks repeatable by id."""
    return tickets_from_rows(table(spark, sf, "orders"), "o_orderkey", "o_orderdate")


@register("triage_templates", f"""
    select ticket_id, product_id, {_SYN['sentiment']} as sentiment,
           {_SYN['urgency_score']} as urgency_score, {_SYN['summary']} as summary
    from ({_synthetic_sql()}) t""")
def triage_templates(spark, sf):
    """F1-F3 with the default rules over generated tickets (every rule fires)."""
    tk = tickets_from_rows(table(spark, sf, "orders"), "o_orderkey", "o_orderdate")
    t = with_triage(tk.select("ticket_id", "product_id", "review_text"), "review_text", flatten=True)
    return t.drop("review_text")


# Keywords of the rule table: the first letters of the words of the benchmark
# items, one rule each, ordered by a hash; outcomes repeat over the rules.
KEYWORD_LETTERS = 6
_RULES_SQL = f"""
    select cast('0x' || substr(md5(keyword), 1, 12) as bigint) as rule_order, keyword from (
        select distinct substr(word, 1, {KEYWORD_LETTERS}) as keyword
        from (select unnest(string_split(lower(text), ' ')) as word from benchmark) where length(word) >= {KEYWORD_LETTERS})"""


@register("triage_rule_table", f"""
    with rules as ({_RULES_SQL}),
    firsts as (select t.ticket_id, min(r.rule_order) as rule_order
               from ({DOC_TICKETS_SQL}) t join rules r on contains(lower(t.review_text), r.keyword) group by t.ticket_id)
    select t.ticket_id,
           case when f.rule_order is null then {_sql_text(DEFAULT_OUTCOME.sentiment)} else 'Negative' end as sentiment,
           coalesce((f.rule_order % 5)::int, {DEFAULT_OUTCOME.urgency_score}) as urgency_score,
           coalesce(r.keyword, {_sql_text(DEFAULT_OUTCOME.summary)}) as summary
    from ({DOC_TICKETS_SQL}) t left join firsts f on t.ticket_id = f.ticket_id left join rules r on f.rule_order = r.rule_order
    where t.review_text is not null
    union all
    select ticket_id, null, null, null from ({DOC_TICKETS_SQL}) t where review_text is null""")
def triage_rule_table(spark, sf):
    """F2-F3 with rules as rows: a keyword for each word of the benchmark items,
    all found in one pass over every whole text; the first rule wins."""
    words = table(spark, sf, "benchmark").select(F.explode(F.split(F.lower("text"), " ")).alias("word"))
    keywords = words.filter(F.length("word") >= KEYWORD_LETTERS) \
        .select(F.substring("word", 1, KEYWORD_LETTERS).alias("keyword")).distinct()
    order = F.conv(F.substring(F.md5("keyword"), 1, 12), 16, 10).cast("long")
    rules = keywords.withColumn("rule_order", order).select(
        "rule_order", "keyword", F.lit("Negative").alias("sentiment"),
        (F.col("rule_order") % 5).cast("int").alias("urgency_score"), F.col("keyword").alias("summary"))
    tickets = doc_tickets(spark, sf).select("ticket_id", "review_text")
    return with_rule_table(tickets, "review_text", rules).select("ticket_id", "triage.*")


# ============================================================ landing / bronze
def _spread(rows: DataFrame) -> DataFrame:
    """At least ``LANDING_PARTS`` partitions; more stay as they are."""
    return rows if rows.rdd.getNumPartitions() >= LANDING_PARTS else rows.repartition(LANDING_PARTS)


def _land(rows: DataFrame, landing: str) -> None:
    write_landing_files(_spread(rows), landing, records_per_file=1_000_000)


def _land_tickets(spark, sf, name: str) -> str:
    landing = scratch_path(spark, f"{name}-landing")
    _land(doc_tickets(spark, sf), landing)
    return landing


def _land_events(spark, sf, name: str) -> str:
    landing = scratch_path(spark, f"{name}-landing")
    _land(raw_events(spark, sf), landing)
    return landing


_TICKETS_SQL = f"select {', '.join(TICKET_COLUMNS)} from ({DOC_TICKETS_SQL}) t"


@register("landing_write_roundtrip", _TICKETS_SQL)
def landing_write_roundtrip(spark, sf):
    """K7 then a batch multi-line read: every ticket comes back, whole."""
    landing = _land_tickets(spark, sf, "roundtrip")
    return read_json_batch(spark, landing, TICKET, multi_line=True)


@register("landing_json_stream", _TICKETS_SQL)
def landing_json_stream_q(spark, sf):
    """The landing folder as a stream of JSON arrays, drained to parquet."""
    landing = _land_tickets(spark, sf, "landing-stream")
    out = scratch_path(spark, "landing-stream-out")
    run_available_now(landing_json_stream(spark, landing), out, scratch_path(spark, "landing-stream-ckpt"))
    return spark.read.schema(TICKET).parquet(out)


@register("schema_on_read", f"""
    select ticket_id, cast(null as varchar) as customer_id, product_id, review_text, "timestamp",
           meta
    from ({doc_tickets_sql(", cast(json_object('lang', lang, 'source', source) as varchar) as meta")}) t""")
def schema_on_read(spark, sf):
    """Declared fields only; a missing field is null, an undeclared one is
    dropped, a nested object declared as string is its JSON text."""
    records = doc_tickets(spark, sf, "n_chars", F.struct("lang", "source").alias("meta")).drop("customer_id")
    landing = scratch_path(spark, "schema-on-read")
    _land(records, landing)
    declared = StructType(TICKET.fields + [StructField("meta", StringType())])
    return read_json_batch(spark, landing, declared, multi_line=True)


@register("bronze_append", f"""
    select {', '.join(TICKET_COLUMNS)}, true as has_ingested_at from ({DOC_TICKETS_SQL}) t""")
def bronze_append(spark, sf):
    """Landing -> bronze twice on one checkpoint; the second
    run must add nothing (exactly once through the sink's commit log)."""
    landing = _land_tickets(spark, sf, "bronze")
    bronze = scratch_path(spark, "bronze-out")
    ckpt = scratch_path(spark, "bronze-ckpt")
    run_bronze(spark, landing, bronze, ckpt)
    first = spark.read.parquet(bronze).count()
    again = run_bronze(spark, landing, bronze, ckpt)
    if batches_with_input(again) != 0 or spark.read.parquet(bronze).count() != first:
        raise AssertionError("rerun on the same checkpoint added rows")
    b = spark.read.parquet(bronze)
    return b.select(*TICKET_COLUMNS, F.col("ingested_at").isNotNull().alias("has_ingested_at"))


@register("bronze_continuous", ORACLES["bronze_append"])
def bronze_continuous(spark, sf):
    """K1, T3 with the default trigger: a running bronze stream picks up files
    that land while it runs (English tickets first, the rest later)."""
    landing = scratch_path(spark, "bronze-continuous-landing")
    bronze = scratch_path(spark, "bronze-continuous-out")
    tickets = doc_tickets(spark, sf, F.col("lang"))
    english = F.col("lang") == F.lit("en")
    _land(tickets.filter(english).drop("lang"), landing)
    query = run_bronze(spark, landing, bronze, scratch_path(spark, "bronze-continuous-ckpt"), trigger=None)
    try:
        query.processAllAvailable()
        later = ~english | F.col("lang").isNull()
        _land(tickets.filter(later).drop("lang"), landing)
        query.processAllAvailable()
    finally:
        query.stop()
    if query.exception() is not None:
        raise query.exception()
    b = spark.read.parquet(bronze)
    return b.select(*TICKET_COLUMNS, F.col("ingested_at").isNotNull().alias("has_ingested_at"))


@contextmanager
def _file_per_task(spark) -> Iterator[None]:
    """Streams that start in here read, and so write, a small file per task."""
    name = "spark.sql.files.openCostInBytes"
    held = spark.conf.get(name)
    spark.conf.set(name, spark.conf.get("spark.sql.files.maxPartitionBytes"))
    try:
        yield
    finally:
        spark.conf.set(name, held)


@register("bronze_compacted", ORACLES["bronze_append"])
def bronze_compacted(spark, sf):
    """K1, K2: a bronze table of many small files (one for each landing file),
    compacted twice on one checkpoint (English tickets first, the rest later)
    into a few large ones; every ticket once, in at most a fifth of the files."""
    root = scratch_path(spark, "bronze-compacted")
    tickets, english = doc_tickets(spark, sf, F.col("lang")), F.col("lang") == F.lit("en")
    for load in (english, ~english | F.col("lang").isNull()):
        write_landing_files(_spread(tickets.filter(load).drop("lang")), f"{root}/landing",
                            records_per_file=SMALL_FILE_RECORDS)
        with _file_per_task(spark):
            run_bronze(spark, f"{root}/landing", f"{root}/bronze", f"{root}/ckpt/bronze",
                       max_files_per_trigger=_rate_limit(_files_in(spark, f"{root}/landing")))
        run_compaction(spark, f"{root}/bronze", f"{root}/compacted", f"{root}/ckpt/compacted",
                       spark.read.parquet(f"{root}/bronze").schema)
    small, large = (spark.read.parquet(f"{root}/{name}") for name in ("bronze", "compacted"))
    if len(large.inputFiles()) > max(2, len(small.inputFiles()) // 5):
        raise AssertionError(f"{len(small.inputFiles())} files became {len(large.inputFiles())}")
    return large.select(*TICKET_COLUMNS, F.col("ingested_at").isNotNull().alias("has_ingested_at"))


# ==================================================================== events
_EVENT_COLUMNS = ["event_id", "user_id", "event_type", "timestamp", "payload"]
_EVENTS_SQL = f"select * from ({RAW_EVENTS_SQL}) e"


@register("event_json_stream", _EVENTS_SQL)
def event_json_stream_q(spark, sf):
    """Line-delimited event files (one array per line) as a rate-limited stream."""
    landing = _land_events(spark, sf, "event-stream")
    out = scratch_path(spark, "event-stream-out")
    stream = event_json_stream(spark, landing, RAW_EVENT, max_files_per_trigger=100)
    run_available_now(stream, out, scratch_path(spark, "event-stream-ckpt"))
    return spark.read.schema(RAW_EVENT).parquet(out)


def _files_in(spark, path: str) -> int:
    """Number of files as a file stream lists them, empty ones included (a
    batch scan leaves those out); file contents are not read."""
    return len(spark.read.format("binaryFile").load(path).inputFiles())


def _rate_limit(files: int) -> int:
    """Files per micro-batch that drain ``files`` in about DRAIN_BATCHES."""
    return max(1, -(-files // DRAIN_BATCHES))


@register("silver_available_now", _EVENTS_SQL)
def silver_available_now(spark, sf):
    """Drain-and-stop honours the rate limit: a quarter of the files per batch."""
    landing = _land_events(spark, sf, "available-now")
    out = scratch_path(spark, "available-now-out")
    files = _files_in(spark, landing)
    limit = _rate_limit(files)
    stream = event_json_stream(spark, landing, RAW_EVENT, max_files_per_trigger=limit)
    query = run_available_now(stream, out, scratch_path(spark, "available-now-ckpt"))
    if batch_count(query) != -(-files // limit):
        raise AssertionError(f"{files} files at {limit} per batch ran {batch_count(query)} batches")
    return spark.read.schema(RAW_EVENT).parquet(out)


@register("rate_limit_invariance", _EVENTS_SQL)
def rate_limit_invariance(spark, sf):
    """T4: a quarter of the files per batch and all of them give the same rows."""
    landing = _land_events(spark, sf, "rate-limit")
    files = _files_in(spark, landing)
    small, large = _rate_limit(files), files + 1
    outs = {}
    for limit in (small, large):
        out = scratch_path(spark, f"rate-limit-{limit}")
        stream = event_json_stream(spark, landing, RAW_EVENT, max_files_per_trigger=limit)
        run_available_now(stream, out, scratch_path(spark, f"rate-limit-{limit}-ckpt"))
        outs[limit] = spark.read.schema(RAW_EVENT).parquet(out)
    if not same_rows(outs[small], outs[large]):
        raise AssertionError("result depends on the rate limit")
    return outs[small]


@register("byte_limit_invariance", _EVENTS_SQL)
def byte_limit_invariance(spark, sf):
    """T4 by size: many small files of clicks and few large ones of the rest, a
    quarter of the bytes per micro-batch; all rows, whatever the limit."""
    landing = scratch_path(spark, "byte-limit-landing")
    events, click = raw_events(spark, sf), F.col("event_type") == F.lit("click")
    write_landing_files(_spread(events.filter(click)), landing, records_per_file=200)
    _land(events.filter(~click), landing)
    total = spark.read.format("binaryFile").load(landing).agg(F.sum("length")).first()[0]
    outs = []
    for limit in (-(-total // DRAIN_BATCHES), total + 1):
        out = scratch_path(spark, "byte-limit-out")
        stream = event_json_stream(spark, landing, RAW_EVENT, max_bytes_per_trigger=limit)
        query = run_available_now(stream, out, scratch_path(spark, "byte-limit-ckpt"))
        outs.append(spark.read.schema(RAW_EVENT).parquet(out))
        if batch_count(query) < -(-total // limit):
            raise AssertionError(f"{total} bytes at {limit} per batch ran {batch_count(query)} batches")
    if not same_rows(*outs):
        raise AssertionError("result depends on the byte limit")
    return outs[0]


@register("require_key", f"{_EVENTS_SQL} where event_id is not null")
def require_key_q(spark, sf):
    """Rows without an event id are dropped (an empty string would pass)."""
    return require_key(raw_events(spark, sf), "event_id")


@register("key_rejects", f"""
    select *, 'missing event_id' as reject_reason from ({RAW_EVENTS_SQL}) e where event_id is null""")
def key_rejects_q(spark, sf):
    """P2 complement: the rejected rows with their reason."""
    return key_rejects(raw_events(spark, sf), "event_id")


@register("lenient_timestamp", f"""
    select event_id, event_type, "timestamp", try_cast("timestamp" as timestamp) as event_timestamp
    from ({RAW_EVENTS_SQL}) e""")
def lenient_timestamp_q(spark, sf):
    """ISO text parses, legacy text becomes null, nothing raises."""
    ev = raw_events(spark, sf).select("event_id", "event_type", "timestamp")
    parsed = parse_timestamp(ev, "timestamp", "event_timestamp", keep_raw=True)
    return parsed.select("event_id", "event_type", "timestamp", ntz("event_timestamp"))


@register("iso_timestamp_roundtrip", f"""
    select event_id, ts, strftime(ts, '{ISO_MICROS_SQL}') as iso_text,
           try_cast(strftime(ts, '{ISO_MICROS_SQL}') as timestamp) as ts_back
    from events""")
def iso_timestamp_roundtrip(spark, sf):
    """F7 and P3 as inverses: microseconds survive the trip through text."""
    e = table(spark, sf, "events").select("event_id", "ts")
    t = e.withColumn("iso_text", iso_text("ts", micros=True))
    back = parse_timestamp(t, "iso_text", "ts_back", keep_raw=True)
    return back.select("event_id", "ts", "iso_text", ntz("ts_back"))


@register("drop_columns", f"""
    select event_id, user_id, event_type, payload, try_cast("timestamp" as timestamp) as event_timestamp
    from ({RAW_EVENTS_SQL}) e""")
def drop_columns_q(spark, sf):
    """The raw time text is dropped once parsed."""
    parsed = parse_timestamp(raw_events(spark, sf), "timestamp", "event_timestamp")
    return drop_columns(parsed, "timestamp").withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


@register("ingest_stamp", f"select *, true as has_ingested_at from ({RAW_EVENTS_SQL}) e")
def ingest_stamp(spark, sf):
    """P1, F6 in a stream: each micro-batch gets its own stamp, none is null."""
    landing = _land_events(spark, sf, "stamp")
    out = scratch_path(spark, "stamp-out")
    limit = _rate_limit(_files_in(spark, landing))
    stream = stamp(event_json_stream(spark, landing, RAW_EVENT, max_files_per_trigger=limit))
    query = run_available_now(stream, out, scratch_path(spark, "stamp-ckpt"))
    res = spark.read.parquet(out)
    stamps = res.select("ingested_at").distinct().count()
    if stamps > batch_count(query):
        raise AssertionError("more stamps than micro-batches")
    return res.select(*_EVENT_COLUMNS, F.col("ingested_at").isNotNull().alias("has_ingested_at"))


_JOIN_SQL = f"""
    select e.user_id, e.event_id, e.event_type, e."timestamp", e.payload,
           {', '.join('d.' + c for c in DIMENSION_COLUMNS)}
    from ({RAW_EVENTS_SQL}) e left join ({USER_DIMENSION_SQL}) d on e.user_id = d.user_id"""


@register("batch_left_join", _JOIN_SQL)
def batch_left_join(spark, sf):
    """J1 on bounded frames; Catalyst / adaptive execution pick the strategy."""
    return left_enrich(raw_events(spark, sf), user_dimension(spark, sf), "user_id")


@register("salted_left_join", _JOIN_SQL)
def salted_left_join(spark, sf):
    """J1 with salting: null keys and measured hot keys are spread over 8 salts,
    and only the hot keys' dimension rows are replicated."""
    return left_enrich(raw_events(spark, sf), user_dimension(spark, sf), "user_id", salt_buckets=8, hot_share=0.001)


@register("stream_static_left_join", _JOIN_SQL)
def stream_static_left_join(spark, sf):
    """J1 stream x static: dimension checked unique, size-checked broadcast,
    materialized once in the checkpoint folder."""
    landing = _land_events(spark, sf, "stream-join")
    out = scratch_path(spark, "stream-join-out")
    stream = event_json_stream(spark, landing, RAW_EVENT)
    joined = left_enrich(stream, user_dimension(spark, sf), "user_id",
                         broadcast_max_rows=5_000_000, validate_unique=True, snapshot=True)
    run_available_now(joined, out, scratch_path(spark, "stream-join-ckpt"))
    return spark.read.parquet(out)


@register("silver_event_flow", f"""
    select e.user_id, e.event_id, e.event_type, e.payload,
           {', '.join('d.' + c for c in DIMENSION_COLUMNS)},
           true as has_ingestion_timestamp,
           try_cast(e."timestamp" as timestamp) as event_timestamp
    from ({RAW_EVENTS_SQL}) e left join ({USER_DIMENSION_SQL}) d on e.user_id = d.user_id
    where e.event_id is not null""")
def silver_event_flow(spark, sf):
    """M2 / T5: require key -> left join dimension -> stamp -> parse -> drop."""
    landing = _land_events(spark, sf, "silver-events")
    out = scratch_path(spark, "silver-events-out")
    run_silver_events(spark, landing, user_dimension(spark, sf), out,
                      scratch_path(spark, "silver-events-ckpt"),
                      broadcast_max_rows=5_000_000, validate_unique=True)
    s = spark.read.parquet(out)
    return s.select(
        "user_id", "event_id", "event_type", "payload", *DIMENSION_COLUMNS,
        F.col("ingestion_timestamp").isNotNull().alias("has_ingestion_timestamp"),
        ntz("event_timestamp"),
    )


# Events of the first load of a changing dimension; the others come later.
FIRST_LOAD = ("view", "click")


@register("changing_dimension_join", f"""
    select e.user_id, e.event_id, e.event_type, e."timestamp", e.payload, d.c_name, d.c_nationkey, d.c_acctbal,
           case when e.event_type in {FIRST_LOAD} then d.c_mktsegment else 'new ' || d.c_mktsegment end as c_mktsegment
    from ({RAW_EVENTS_SQL}) e left join ({USER_DIMENSION_SQL}) d
      on e.user_id = d.user_id and (e.event_type in {FIRST_LOAD} or d.c_nationkey <> 0)""")
def changing_dimension_join(spark, sf):
    """J1 with a dimension that gains a version between two micro-batches: other
    segments, and the users of one nation gone. Every event is joined with the
    version of its own micro-batch."""
    root = scratch_path(spark, "changing-dimension")
    events, first = raw_events(spark, sf), F.col("event_type").isin(*FIRST_LOAD)
    versions = (user_dimension(spark, sf), user_dimension(spark, sf).filter("c_nationkey <> 0").withColumn(
        "c_mktsegment", F.concat(F.lit("new "), "c_mktsegment")))
    for load, version in zip((events.filter(first), events.filter(~first)), versions):
        _land(load, f"{root}/landing")
        version.write.mode("overwrite").parquet(f"{root}/dim")
        enrich_each_batch(event_json_stream(spark, f"{root}/landing", RAW_EVENT), lambda: spark.read.parquet(f"{root}/dim"),
                          "user_id", f"{root}/out", f"{root}/ckpt", broadcast_max_rows=5_000_000)
    return spark.read.parquet(f"{root}/out").drop("batch")


HOT_USER = "7"
_HOT_EVENTS_SQL = f"""
    select event_id, case when event_type in {FIRST_LOAD} and user_id is not null then '{HOT_USER}' else user_id end as user_id,
           event_type, "timestamp", payload from ({RAW_EVENTS_SQL}) r"""


@register("hot_key_stream_join", f"""
    select e.user_id, e.event_id, e.event_type, e."timestamp", e.payload, {', '.join('d.' + c for c in DIMENSION_COLUMNS)}
    from ({_HOT_EVENTS_SQL}) e left join ({USER_DIMENSION_SQL}) d on e.user_id = d.user_id""")
def hot_key_stream_join(spark, sf):
    """J1 with a user that holds two fifths of a stream: a sketch carried from
    micro-batch to micro-batch names the hot keys, which are salted."""
    root = scratch_path(spark, "hot-keys")
    hot = F.col("event_type").isin(*FIRST_LOAD) & F.col("user_id").isNotNull()
    _land(raw_events(spark, sf).withColumn("user_id", F.when(hot, F.lit(HOT_USER)).otherwise(F.col("user_id"))),
          f"{root}/landing")
    limit = _rate_limit(_files_in(spark, f"{root}/landing"))
    enrich_each_batch(event_json_stream(spark, f"{root}/landing", RAW_EVENT, max_files_per_trigger=limit),
                      lambda: user_dimension(spark, sf), "user_id", f"{root}/out", f"{root}/ckpt",
                      salt_buckets=8, hot_share=0.05)
    return spark.read.parquet(f"{root}/out").drop("batch")


# ==================================================================== upsert
def _load_metrics_sql(where: str) -> str:
    return f"""
    select cast(l_partkey as varchar) as product_id, count(l_orderkey) as total_reviews,
           avg(l_quantity) as avg_urgency, cast(avg(l_quantity) as decimal(4,2)) as avg_urgency_rating
    from lineitem where {where} group by l_partkey"""


def _load_metrics(spark, sf, cond) -> DataFrame:
    li = table(spark, sf, "lineitem").filter(cond)
    rows = li.select(
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_orderkey").alias("ticket_id"),
        F.col("l_quantity").alias("urgency_score"),
    )
    return gold_ops.product_metrics(rows, rating=True)


_LOADS_SQL = [_load_metrics_sql(where) for where in (
    f"l_shipdate < timestamp '{LOAD_BORDERS[0]}'",
    f"l_shipdate >= timestamp '{LOAD_BORDERS[0]}' and l_shipdate < timestamp '{LOAD_BORDERS[1]}'",
    f"l_shipdate >= timestamp '{LOAD_BORDERS[1]}' or l_shipdate is null")]


@register("gold_upsert", f"""
    with loads as ({' union all '.join(f'select *, {i} as load from ({q}) t{i}' for i, q in enumerate(_LOADS_SQL))})
    select product_id, total_reviews, avg_urgency, avg_urgency_rating,
           cast(0 as bigint) as negative_ticket_count, cast(0 as bigint) as positive_ticket_count,
           true as has_last_updated_at
    from loads qualify row_number() over (partition by product_id order by load desc) = 1""")
def gold_upsert(spark, sf):
    """K4-K5: three loads that cover all order lines, upserted in order; the
    target has each product's metrics of its latest load: replaced,
    surviving and inserted products (staged keys broadcast, target not shuffled)."""
    return _gold_upsert(spark, sf, "gold-upsert", UPSERT_BROADCAST_ROWS)


def _gold_upsert(spark, sf, name: str, broadcast_max_rows):
    root = scratch_path(spark, name)
    first, second = (F.lit(d).cast("timestamp_ntz") for d in LOAD_BORDERS)
    shipped = F.col("l_shipdate")
    for load in (shipped < first, (shipped >= first) & (shipped < second), (shipped >= second) | shipped.isNull()):
        # staged metrics are small (one row per product): materialized once, as run_gold does
        staged = materialize(_load_metrics(spark, sf, load), "gold-load")
        merge_target(staged, root, GOLD_KEY, partial(merge_into_target, broadcast_max_rows=broadcast_max_rows),
                     GOLD_TARGET)
    cur = read_target(spark, root)
    return cur.select(
        *[c for c in cur.columns if c != "last_updated_at"],
        F.col("last_updated_at").isNotNull().alias("has_last_updated_at"),
    )


@register("gold_upsert_shuffled", ORACLES["gold_upsert"])
def gold_upsert_shuffled(spark, sf):
    """K4 through the other plan: one full outer join on the key (the path for
    staged batches above the broadcast bound); same result as gold_upsert."""
    return _gold_upsert(spark, sf, "gold-upsert-shuffled", None)


@register("target_evolve", f"""
    select cast(l_partkey as varchar) as product_id, count(l_orderkey) as total_reviews,
           avg(l_quantity) as avg_urgency, cast(0.00 as decimal(4,2)) as avg_urgency_rating,
           cast(0 as bigint) as negative_ticket_count, cast(0 as bigint) as positive_ticket_count,
           true as has_last_updated_at
    from lineitem group by l_partkey""")
def target_evolve(spark, sf):
    """K5: a target in the narrow job shape gains every missing gold column
    with its default (counts 0, rating 0.00, stamp now)."""
    narrow = gold_ops.product_metrics(
        line_tickets(spark, sf).withColumn("product_id", F.col("product_id").cast("string"))
    )
    root = scratch_path(spark, "target-evolve")
    replace_target(narrow, root, GOLD_KEY)
    healed = evolve(read_target(spark, root), GOLD_TARGET, GOLD_DEFAULTS, now_columns=("last_updated_at",))
    return healed.select(
        *[c for c in healed.columns if c != "last_updated_at"],
        F.col("last_updated_at").isNotNull().alias("has_last_updated_at"),
    )


# ================================================================ scans, jobs
@register("parquet_scan_guarded", "select * from orders")
def parquet_scan_guarded(spark, sf):
    """A missing folder next to a real table is skipped, not an error."""
    orders = table(spark, sf, "orders")
    missing = scratch_path(spark, "never-written")
    return read_parquet_guarded(spark, [f"{sf.rstrip('/')}/orders.parquet", missing], orders.schema)


_TK_SILVER = triage_sql("review_text", TEXT_RULES, DEFAULT_OUTCOME)


@register("ticket_silver", f"""
    select ticket_id, customer_id, product_id, review_text,
           {_TK_SILVER['sentiment']} as sentiment, {_TK_SILVER['urgency_score']} as urgency_score,
           {_TK_SILVER['summary']} as summary,
           try_cast("timestamp" as timestamp) as ticket_timestamp,
           true as has_processed_at
    from ({DOC_TICKETS_SQL}) t""")
def ticket_silver(spark, sf):
    """M1 + M4: landing -> bronze -> triaged silver, both streams drained."""
    landing = _land_tickets(spark, sf, "ticket-silver")
    root = scratch_path(spark, "ticket-silver")
    run_bronze(spark, landing, f"{root}/bronze", f"{root}/ckpt/bronze")
    run_silver_tickets(spark, f"{root}/bronze", f"{root}/silver", f"{root}/ckpt/silver", TEXT_RULES)
    s = spark.read.parquet(f"{root}/silver")
    return s.select(
        "ticket_id", "customer_id", "product_id", "review_text", "sentiment", "urgency_score",
        "summary", ntz("ticket_timestamp"), F.col("processed_at").isNotNull().alias("has_processed_at"),
    )


def medallion_sql() -> str:
    t = triage_sql("review_text", TEXT_RULES, DEFAULT_OUTCOME)
    return f"""
    with s as (
        select ticket_id, product_id, cast({t['urgency_score']} as double) as urgency_score,
               {t['sentiment']} as sentiment
        from ({DOC_TICKETS_SQL}) t)
    select product_id, count(ticket_id) as total_reviews, avg(urgency_score) as avg_urgency,
           cast(avg(urgency_score) as decimal(4,2)) as avg_urgency_rating,
           count(*) filter (where sentiment = 'Negative') as negative_ticket_count,
           count(*) filter (where sentiment = 'Positive') as positive_ticket_count,
           true as has_last_updated_at
    from s group by product_id"""


@register("medallion_run", medallion_sql())
def medallion_run(spark, sf):
    """M5: the whole chain, landing -> bronze -> silver -> gold -> published target."""
    root = scratch_path(spark, "medallion")
    landing = f"{root}/landing"
    _land(doc_tickets(spark, sf), landing)
    paths = ChainPaths.under(root, landing)
    run_chain(spark, paths, rules=TEXT_RULES)
    cur = read_target(spark, paths.gold)
    return cur.select(
        *[c for c in cur.columns if c != "last_updated_at"],
        F.col("last_updated_at").isNotNull().alias("has_last_updated_at"),
    )


@register("medallion_incremental", medallion_sql())
def medallion_incremental(spark, sf):
    """M5 with incremental gold: tickets land in two loads (English texts
    first, then the other languages); after each load the chain runs again on
    the same checkpoints and gold only aggregates the new silver files into
    its per-product state. The final target equals a full recomputation."""
    root = scratch_path(spark, "medallion-incremental")
    landing = f"{root}/landing"
    paths = ChainPaths.under(root, landing)
    tickets = doc_tickets(spark, sf, F.col("lang"))
    for load in (F.col("lang") == F.lit("en"), ~(F.col("lang") == F.lit("en")) | F.col("lang").isNull()):
        _land(tickets.filter(load).drop("lang"), landing)
        run_chain(spark, paths, rules=TEXT_RULES, incremental=True)
    cur = read_target(spark, paths.gold)
    return cur.select(
        *[c for c in cur.columns if c != "last_updated_at"],
        F.col("last_updated_at").isNotNull().alias("has_last_updated_at"),
    )


@register("silver_event_rejects", f"""
    select *, 'missing event_id' as reject_reason from ({RAW_EVENTS_SQL}) e where event_id is null""")
def silver_event_rejects(spark, sf):
    """P2 in the event stream: rows without an event id land in a rejects
    output, so rows in = silver rows + rejects."""
    landing = _land_events(spark, sf, "silver-rejects")
    root = scratch_path(spark, "silver-rejects")
    run_silver_events(spark, landing, user_dimension(spark, sf), f"{root}/silver", f"{root}/ckpt",
                      rejects=f"{root}/rejects", broadcast_max_rows=5_000_000)
    kept = spark.read.parquet(f"{root}/silver").count()
    rej = spark.read.parquet(f"{root}/rejects")
    if kept + rej.count() != table(spark, sf, "events").count():
        raise AssertionError("rows in differ from silver rows + rejects")
    return rej.select(*_EVENT_COLUMNS, "reject_reason")


SECOND_LOAD_FROM = "1998-01-01"


@register("gold_incremental_loads", """
    select cast(l_partkey as varchar) as product_id, count(l_orderkey) as total_reviews,
           avg(l_quantity) as avg_urgency, cast(avg(l_quantity) as decimal(4,2)) as avg_urgency_rating,
           cast(0 as bigint) as negative_ticket_count, cast(0 as bigint) as positive_ticket_count,
           true as has_last_updated_at
    from lineitem group by l_partkey""")
def gold_incremental_loads(spark, sf):
    """M3 incremental at table scale: order lines arrive in silver in two loads
    (shipped before 1998, then the rest); after each load the streaming
    aggregation folds only the new files into its per-product state and
    upserts the touched products. The final target equals a full aggregation."""
    root = scratch_path(spark, "gold-incremental-loads")
    li = table(spark, sf, "lineitem")
    rows = li.select(
        F.col("l_orderkey").cast("string").alias("ticket_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").alias("urgency_score"),
        F.lit(None).cast("string").alias("sentiment"),
        "l_shipdate",
    )
    early = F.col("l_shipdate") < F.lit(SECOND_LOAD_FROM).cast("timestamp_ntz")
    schema = rows.drop("l_shipdate").schema
    for load in (early, ~early | F.col("l_shipdate").isNull()):
        rows.filter(load).drop("l_shipdate").write.mode("append").parquet(f"{root}/silver")
        run_gold_incremental(spark, f"{root}/silver", f"{root}/gold", f"{root}/ckpt", schema)
    cur = read_target(spark, f"{root}/gold")
    return cur.select(
        *[c for c in cur.columns if c != "last_updated_at"],
        F.col("last_updated_at").isNotNull().alias("has_last_updated_at"),
    )


# ============================================================ rejects, ids
@register("landing_rejects", """
    select 'DOC-' || cast(doc_id as varchar) as ticket_id,
           case when lang in ('de', 'fr') then 'unparsable landing file' else 'kept' end as outcome
    from documents""")
def landing_rejects(spark, sf):
    """S1, M1, M4 on a damaged feed: German tickets land in files of two arrays,
    French ones in files that break off; every landed ticket is either in
    silver or, with its file's text, in the rejects."""
    root = scratch_path(spark, "landing-rejects")
    tickets = doc_tickets(spark, sf, F.col("lang"))
    damage = {"de": F.concat("value", F.lit("\n"), "value"),
              "fr": F.expr("substring(value, 1, char_length(value) - 2)")}
    known = F.coalesce(F.col("lang").isin(*damage), F.lit(False))
    _land(tickets.filter(~known).drop("lang"), f"{root}/landing")
    for lang, broken in damage.items():
        arrays = landing_arrays(_spread(tickets.filter(F.col("lang") == lang).drop("lang")), 1_000_000)
        arrays.select(broken.alias("value")).write.mode("append").option("maxRecordsPerFile", 1) \
            .option("lineSep", "\n").text(f"{root}/landing")
    run_bronze(spark, f"{root}/landing", f"{root}/bronze", f"{root}/ckpt/bronze")
    run_silver_tickets(spark, f"{root}/bronze", f"{root}/silver", f"{root}/ckpt/silver", TEXT_RULES,
                       rejects=f"{root}/rejects")
    kept = spark.read.parquet(f"{root}/silver").select("ticket_id", F.lit("kept").alias("outcome"))
    ids = F.explode(F.array_distinct(F.regexp_extract_all(CORRUPT, F.lit('"ticket_id":"(DOC-[0-9]+)"'), F.lit(1))))
    lost = spark.read.parquet(f"{root}/rejects").select(ids.alias("ticket_id"), F.col("reject_reason").alias("outcome"))
    return kept.unionByName(lost.distinct())  # a ticket of two arrays is rejected with each


@register("gold_rejects", """
    select 'DOC-' || cast(doc_id as varchar) as ticket_id, cast(null as varchar) as product_id,
           'missing product_id' as reject_reason
    from documents where lang = 'es'""")
def gold_rejects(spark, sf):
    """M3: tickets without a product leave gold as tickets, once each, over two
    loads of incremental gold (Spanish tickets carry no product)."""
    root = scratch_path(spark, "gold-rejects")
    rows = doc_tickets(spark, sf, F.col("lang")).select(
        "ticket_id", F.when(~F.col("lang").eqNullSafe(F.lit("es")), F.col("product_id")).alias("product_id"),
        F.lit(1.0).alias("urgency_score"), F.lit("Positive").alias("sentiment"), "timestamp")
    border = F.lit("2024-01-01T08")
    schema = rows.drop("timestamp").schema
    for load in (F.col("timestamp") < border, F.col("timestamp") >= border):
        rows.filter(load).drop("timestamp").write.mode("append").parquet(f"{root}/silver")
        run_gold_incremental(spark, f"{root}/silver", f"{root}/gold", f"{root}/ckpt", schema, f"{root}/rejects")
    return spark.read.parquet(f"{root}/rejects").select("ticket_id", "product_id", "reject_reason")


@register("random_ticket_ids", """
    select count(*) as tickets, count(*) as distinct_ids, count(*) as uuid_shaped from orders""")
def random_ticket_ids(spark, sf):
    """F8: random ids are distinct and have the shape of a uuid."""
    tickets = tickets_from_rows(table(spark, sf, "orders"), "o_orderkey", "o_orderdate", random_ids=True)
    shape = "^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    return tickets.groupBy("ticket_id").agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("tickets"), F.count(F.lit(1)).alias("distinct_ids"),
        F.sum(F.when(F.col("ticket_id").rlike(shape), F.col("n")).otherwise(0)).alias("uuid_shaped"))


@register("event_epoch_seconds", """
    select event_id, cast(floor(epoch(ts)) as bigint) as epoch_seconds from events""")
def event_epoch_seconds(spark, sf):
    """event times as seconds since the epoch."""
    return table(spark, sf, "events").select("event_id", epoch_seconds(F.col("ts")).alias("epoch_seconds"))
