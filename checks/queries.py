"""The registered queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixtures as X
from tidemark.config import SAMPLE_ROW_SCHEMA
from tidemark.functions import clock
from tidemark.operators import audit, changes, contract, deadletter, envelope, flatten, merge, watermark
from tidemark.plans import deadletters, folders, intake, landing, merging
from tidemark.plans.deadletters import Letters
from tidemark.plans.merging import Target
from tidemark.plans.reports import Accounts, DeliveryLog
from tidemark.session import fresh_dir
from tidemark.sources import control, feed, rawzone, registry, topic
from tidemark.streaming import jobs, progress

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------- merge


@query
def merge_net(spark, d):
    return merge.net(X.target(spark, d), X.batch(spark, d), X.SLOT_KEYS, X.ORDER)


@query
def merge_phased(spark, d):
    return merge.phased(X.target(spark, d), X.batch(spark, d), X.SLOT_KEYS, X.ORDER)


@query
def merge_composite_key(spark, d):
    return merge.net(X.line_target(spark, d), X.line_batch(spark, d), X.PART_KEYS, X.PART_ORDER)


@query
def merge_insert(spark, d):
    return merge.merge_insert(X.target(spark, d), X.latest_per_kind(spark, d, "I"), X.SLOT_KEYS)


@query
def merge_update(spark, d):
    return merge.merge_update(X.target(spark, d), X.latest_per_kind(spark, d, "U"), X.SLOT_KEYS)


@query
def merge_delete(spark, d):
    return merge.merge_delete(X.target(spark, d), X.latest_per_kind(spark, d, "D"), X.SLOT_KEYS)


@query
def merge_counts(spark, d):
    net = changes.latest(X.batch(spark, d).select(*X.SLOT_KEYS, "op", *X.ORDER), X.SLOT_KEYS, X.ORDER)
    return audit.merge_counts(X.target(spark, d), net, X.SLOT_KEYS)


@query
def merge_day(spark, d):
    """The daily job: what was before the cut, then the raw folder of a day, then all later changes."""
    log = X.slot_changes(spark, d)
    raw = fresh_dir(spark, "raw")
    rawzone.write(log.withColumn(rawzone.DAY, F.to_date("ts")), raw)
    target = _slots_target(spark, log)
    merging.merge_changes(target, log.filter(F.col("ts") < X.moment(X.CUT)), "2024-01-15")
    for _ in range(2):  # a run that is repeated changes nothing
        merging.merge_day(target, raw, "2024-01-16")
    merging.merge_changes(target, log.filter(F.col("ts") >= X.moment("2024-01-16 00:00:00")), "2024-02-01")
    return target.rows()


@query
def merge_ties(spark, d):
    """Changes of one hour count as simultaneous: at once, and in batches that come out of order."""
    log = X.slot_changes(spark, d).withColumn("ts", F.date_trunc("hour", F.col("ts").cast("timestamp")))
    log = log.select(*X.SLOT_ROW, "op", "ts", "seq")
    target = Target(spark, fresh_dir(spark, "ties"), log.schema, tuple(X.SLOT_KEYS), ("ts",))
    for part in (2, 0, 1, 2):
        target.add(log.filter(F.col("seq") % 3 == part), f"part-{part}")
    stepwise = merge.live(target.state(), ["ts"]).withColumn("how", F.lit("batches"))
    at_once = merge.live(changes.latest(log, X.SLOT_KEYS, ["ts"]), ["ts"]).withColumn("how", F.lit("once"))
    return at_once.unionByName(stepwise)


@query
def merge_folders(spark, d):
    """A folder per event type, which a row leaves with every change; days out of order, one of them twice, old versions expired."""
    target, log = _folder_target(spark, d, "event_type"), X.slot_changes(spark, d)
    late = F.col("ts") >= X.moment(X.BROKER_DOWN)
    early = F.col("ts") < X.moment(X.CUT)
    for day, part in (("2024-01-31", late), ("2024-02-01", early), ("2024-02-01", early), ("2024-02-02", ~late & ~early)):
        folders.merge_changes(target, log.filter(part), day)
    folders.expire(target, 1)
    return target.rows()


@query
def merge_folders_touched(spark, d):
    """Which version every folder is in, and how many keys it holds: the later days change some slots only."""
    target, log = _folder_target(spark, d, "slot"), X.slot_changes(spark, d)
    before = F.col("ts") < X.moment(X.CUT)
    after = F.col("ts") >= X.moment(X.CUT)
    for day, part in (("2024-01-15", before), ("2024-01-20", after & (F.col("slot") % 4 == 1)), ("2024-01-31", after & (F.col("slot") == 5))):
        folders.merge_changes(target, log.filter(part), day)
    return target.versions().select(F.col(folders.FOLDER).alias("folder"), "day", "n")


# ---------------------------------------------------------------- change sets


@query
def net_changes(spark, d):
    log = X.changelog(spark, d).select(*X.KEYS, "op", *X.ORDER)
    return changes.latest(log, X.KEYS, X.ORDER).select("user_id", "op", F.col("seq").alias("event_id"))


@query
def ambiguous_matches(spark, d):
    return changes.ambiguous(X.changelog(spark, d), X.KEYS)


@query
def op_split(spark, d):
    return changes.count_by_op(X.changelog(spark, d))


@query
def dedupe_events(spark, d):
    """All events plus everything an inclusive refetch from the mark brings a second time."""
    log = X.changelog(spark, d)
    refetched = watermark.changed_since(log, "ts", X.moment(X.CUT))
    return changes.dedupe(log.unionByName(refetched), ["user_id", "ts", "seq"]).select(F.col("seq").alias("event_id"))


@query
def replay_guard(spark, d):
    """Three stretches of time applied last first, and the first of them once more."""
    log = X.changelog(spark, d)
    late = log.filter(F.col("ts") >= X.moment(X.BROKER_DOWN))
    middle = log.filter((F.col("ts") >= X.moment(X.CUT)) & (F.col("ts") < X.moment(X.BROKER_DOWN)))
    early = log.filter(F.col("ts") < X.moment(X.CUT))
    target = Target(spark, fresh_dir(spark, "guard"), log.schema, tuple(X.KEYS), tuple(X.ORDER))
    for name, part in (("late", late), ("early", early), ("middle", middle), ("late", late)):
        target.add(part, name)
    return target.rows()


# ---------------------------------------------------------------- envelope and contract


@query
def envelope_classify(spark, d):
    return envelope.classify_envelope(X.lines(spark, d)).groupBy("reason").agg(F.count("*").alias("n"))


@query
def envelope_valid(spark, d):
    rows = envelope.classify(X.lines(spark, d), X.FEED.keys, X.LINE_SCHEMA)
    return envelope.image_rows(rows, X.LINE_SCHEMA, carry=["event_id"]).select("event_id", "id", "op", "ts_ms", "v")


@query
def quarantine_rows(spark, d):
    rows = envelope.classify(X.line_bytes(spark, d), X.FEED.keys, X.LINE_SCHEMA, binary=True)
    return envelope.quarantined(rows).select("event_id", "reason")


@query
def schema_validate(spark, d):
    rows = _classified(spark, d).filter("violations is not null")
    return rows.select("event_id", F.array_join("violations", ",").alias("violations"))


@query
def schema_versions(spark, d):
    """Events around the day a second schema version came into force, each checked against the one it names."""
    rows = envelope.classify(X.versioned_lines(spark, d), X.FEED.keys, X.LINE_SCHEMA, versions={1: X.LINE_SCHEMA, 2: X.SECOND_SCHEMA})
    return rows.select("event_id", "reason", F.array_join("violations", ",").alias("violations"))


@query
def pk_discovery(spark, d):
    return envelope.key_columns(_classified(spark, d).filter("key_text is not null"))


@query
def message_error_filter(spark, d):
    return envelope.error_counts(X.messages(spark, d)).withColumn("partition", F.col("partition").cast("bigint"))


@query
def image_select(spark, d):
    rows = envelope.image_rows(_classified(spark, d), X.LINE_SCHEMA, carry=["event_id"])
    return rows.select("event_id", "id", "v", "op")


@query
def schema_drift(spark, d):
    registered = T.StructType([*X.LINE_SCHEMA.fields, T.StructField("note", T.StringType())])
    return contract.drift(spark, _classified(spark, d).filter("image is not null"), registered)


@query
def schema_drift_nested(spark, d):
    """Whole nested documents against a schema that has changed inside its arrays."""
    part = T.StructType().add("id", "string").add("type", "long").add("size", "long")
    registered = T.StructType([*SAMPLE_ROW_SCHEMA.fields[:-1], T.StructField("topping", T.ArrayType(part))])
    images = X.documents(spark, d).select(F.parse_json(F.to_json(F.struct("*"))).alias("image"))
    return contract.drift(spark, images, registered, nested=True)


@query
def audit_counts(spark, d):
    return audit.intake_counts(_classified(spark, d))


# ---------------------------------------------------------------- flatten


@query
def flatten_arrays(spark, d):
    flat = flatten.flatten(X.documents(spark, d))
    joined = [F.array_join(c, ",").alias(c) for c in ("batters_ids", "batters_types", "topping_ids", "topping_types")]
    return flat.select("id", "type", "name", "ppu", *joined)


@query
def flatten_generic(spark, d):
    flat = flatten.flatten(X.deep_documents(spark, d), rename={"lines.part.word": "words"})
    words = F.array_join(F.transform("words", lambda line: F.array_join(line, " ")), ",")
    return flat.select(
        "id", "meta_lang", "meta_origin_source", "meta_origin_n_chars", F.array_join("lines_ids", ",").alias("lines_ids"),
        words.alias("words"),
    )


@query
def json_document_scan(spark, d):
    """Nested documents through JSON files and the registered schema."""
    docs = X.documents(spark, d)
    path = fresh_dir(spark, "documents")
    docs.write.json(path)
    back = feed.read_documents(spark, path, SAMPLE_ROW_SCHEMA, multi_line=False)
    return back.select("id", "type", "name", F.array_join("topping.type", "\n").alias("text"),
                       F.size("batters.batter").cast("bigint").alias("n_words"))


# ---------------------------------------------------------------- topic, time, raw zone


@query
def topic_encode(spark, d):
    events = X.table(spark, d, "events").select(
        "event_id",
        F.struct(F.col("user_id").cast("string").alias("id")).alias("key"),
        F.struct("event_type", "value", clock.micros("ts").alias("ts_us")).alias("value"),
    )
    return topic.encode(events, "events", X.FEED.topic_partitions).select(
        "event_id",
        F.col("key").cast("string").alias("key_text"),
        F.octet_length("value").cast("bigint").alias("value_len"),
    )


@query
def event_time(spark, d):
    timed = X.table(spark, d, "events").select(
        "event_id", "ts", clock.micros("ts").alias("ts_us"), clock.millis("ts").alias("ts_ms")
    )
    same = clock.from_micros("ts_us") == F.col("ts").cast("timestamp")
    return timed.select(
        "event_id", "ts_us", "ts_ms", F.when(same, 1).otherwise(0).cast("bigint").alias("round_trip"),
        clock.day_label(clock.from_millis("ts_ms")).alias("day"),
    )


@query
def raw_partition_counts(spark, d):
    path, schema = _raw_events(spark, d)
    return rawzone.day_counts(rawzone.read(spark, path, schema)).select(
        clock.day_label(rawzone.DAY).alias("ingest_date"), "n"
    )


@query
def raw_day_scan(spark, d):
    path, schema = _raw_events(spark, d)
    day = rawzone.read_day(spark, path, schema, run_date="2024-01-16")
    return day.select(F.col("seq").alias("event_id"), "user_id", "op")


@query
def raw_csv_roundtrip(spark, d):
    flat = flatten.flatten(X.documents(spark, d))
    path = fresh_dir(spark, "raw-csv")
    rawzone.write(flat.withColumn(rawzone.DAY, F.to_date(F.lit("2024-01-15"))), path, "csv", many_days=False)
    back = rawzone.read(spark, path, flat.schema, "csv")
    return back.select(
        "id", "type", "ppu",
        F.array_join("batters_types", " ").alias("words"),
        F.array_join("topping_ids", ",").alias("topping_ids"),
    )


@query
def raw_csv_quarantine(spark, d):
    """A day of text rows, ragged ones and ill-typed ones among them: the good ones are merged, the others are letters."""
    raw, letters = fresh_dir(spark, "raw-csv"), Letters(spark, fresh_dir(spark, "letters"))
    for name, rows in zip(("whole", "ragged"), X.raw_text_rows(spark, d), strict=True):
        rawzone.write(rows.withColumn(rawzone.DAY, F.to_date(F.lit("2024-01-15"))), raw, "csv", name, many_days=False)
    target = Target(spark, fresh_dir(spark, "target"), X.RAW_SCHEMA, ("event_id",), ())
    for _ in range(2):  # a run that is repeated puts its letters once
        good = merging.day_rows(target, raw, "2024-01-16", "csv", letters)
    rows = good.select("event_id", "user_id", "value", F.array_join("tags", ",").alias("tags"), F.lit("ok").alias("fate"), F.lit(0).cast("bigint").alias("puts"))
    text = letters.read().select(
        F.split("raw", ",")[0].cast("bigint").alias("event_id"), F.lit(None).cast("bigint").alias("user_id"),
        F.lit(None).cast("double").alias("value"), F.lit(None).cast("string").alias("tags"), F.col("reason").alias("fate"), "puts",
    )
    return rows.unionByName(text)


@query
def raw_compaction(spark, d):
    """Six batches of all days; two days are compacted, one gets another batch and is compacted again; then the batches go."""
    log, raw = X.changelog(spark, d), fresh_dir(spark, "raw")
    days = ("2024-01-15", "2024-01-16")
    dated = log.withColumn(rawzone.DAY, F.to_date("ts"))
    for k in range(6):
        rawzone.write(dated.filter(F.col("seq") % 7 == k), raw, batch=f"landing-{k}")
    for day in days:
        rawzone.compact(spark, raw, day, log.schema)
    rawzone.write(dated.filter(F.col("seq") % 7 == 6), raw, batch="late")
    rawzone.compact(spark, raw, days[0], log.schema)
    for day in days:
        rawzone.drop_compacted(spark, raw, day)
    found = rawzone.read(spark, raw, log.schema).select(rawzone.DAY, "seq", F.input_file_name().alias("file"))
    per_day = found.groupBy(rawzone.DAY).agg(F.count("*").alias("n"), F.sum("seq").alias("seqs"), F.countDistinct("file").alias("files"))
    day = clock.day_label(rawzone.DAY)
    # the days that are not compacted have a file or more for each batch
    small = F.when(day.isin(*days), F.col("files")).otherwise(F.least("files", F.lit(2)))
    return per_day.select(day.alias("ingest_date"), "n", "seqs", small.cast("bigint").alias("files"))


@query
def incremental_scan(spark, d):
    since = watermark.changed_since(X.table(spark, d, "events"), "ts", X.moment(X.CUT))
    return since.select("event_id", clock.micros("ts").alias("ts_us"))


@query
def watermark_lookup(spark, d):
    """Marks of a stored control table that every day of events has added to."""
    path = fresh_dir(spark, "control")
    events = X.table(spark, d, "events")
    daily = events.groupBy(F.col("event_type").alias("feed_name"), F.to_date("ts").alias("day")).agg(
        F.max(clock.micros("ts")).alias("last_upd")
    )
    for parity in (1, 0):
        control.append(daily.filter(F.day("day") % 2 == parity).select("feed_name", "last_upd"), path)
    return watermark.marks(control.read(spark, path))


@query
def watermark_advance(spark, d):
    """A fetch that brings news for most feeds, nothing for one, and only old events for another."""
    events = X.table(spark, d, "events")
    feed = F.col("event_type")
    news = (F.col("ts") >= X.moment(X.CUT)) & ~feed.isin("error", "view")
    old = (F.col("ts") < X.moment("2024-01-05 00:00:00")) & (feed == "view")
    seen = events.filter(news | old).select(feed.alias("feed_name"), clock.micros("ts").alias("last_upd"))
    return watermark.advance(_control(spark, d), seen)


# ---------------------------------------------------------------- dead letters


@query
def dlq_put(spark, d):
    """All faulty lines, put under their record key where the line has one."""
    bad = envelope.quarantined(_classified(spark, d))
    log = deadletter.puts(bad, "line", deadletter.record_key("line", "key_text"), "reason", F.col("ts").cast("timestamp"))
    return deadletter.state(log).select("dlq_key", "raw", "reason", "puts")


@query
def dlq_retry_split(spark, d):
    side = F.when(F.col("retriable"), "retry").otherwise("stale").alias("side")
    return _letters_by_record(spark, d).groupBy(side, "reason").agg(
        F.count("*").alias("n"), F.sum("puts").alias("puts")
    )


@query
def dlq_alerts(spark, d):
    return deadletter.alerts(_letters_by_record(spark, d)).select("reason", "n", clock.micros("oldest").alias("oldest_us"))


@query
def dlq_purge(spark, d):
    letters = _stored_letters(spark, d)
    deadletters.purge(letters, fresh_dir(spark, "alerts"))
    return _letter_counts(letters.read())


@query
def dlq_replay(spark, d):
    """Undelivered lines go out again; those the row contract refuses stay behind."""
    letters = _stored_letters(spark, d)
    out = fresh_dir(spark, "replayed")
    deadletters.replay(letters, X.FEED, lambda m: topic.publish(m, X.FEED, out))
    sent = spark.read.schema(topic.MESSAGE_SCHEMA).parquet(out).select(
        F.lit("delivered").alias("reason"), F.lit(1).alias("attempts"), F.lit(1).cast("bigint").alias("puts")
    )
    return _letter_counts(letters.read().select("reason", "attempts", "puts").unionByName(sent))


@query
def dlq_failover(spark, d):
    """The topic is down: the good lines of the batch become retriable dead letters."""
    letters = Letters(spark, fresh_dir(spark, "letters"))
    intake.deliver(X.FEED, _with_values(spark, d), letters, _down)
    return letters.read().groupBy("reason", F.col("retriable").cast("string").alias("retriable")).agg(
        F.count("*").alias("n"), F.sum("puts").alias("puts")
    )


@query
def dlq_outage(spark, d):
    """A long outage: many polls, a batch that is run again, a purge and a failed replay; then everything goes out."""
    letters, out = Letters(spark, fresh_dir(spark, "letters")), fresh_dir(spark, "topic")
    # all polls bring these lines, so they are stored as they were classified
    lines = _with_values(spark, d).select(*intake.CHECKED).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for poll in ("poll-1", "poll-2", "poll-3", "poll-3"):
            intake.deliver(X.FEED, lines, letters, _down, poll)
    finally:
        lines.unpersist()
    deadletters.purge(letters, fresh_dir(spark, "alerts"))
    deadletters.replay(letters, X.FEED, _down)
    letters.compact()
    deadletters.replay(letters, X.FEED, lambda m: topic.publish(m, X.FEED, out))
    deadletters.replay(letters, X.FEED, lambda m: topic.publish(m, X.FEED, out))
    return _published(spark, out)


@query
def intake_run(spark, d):
    """Two feeds in turns over one control table: fetched up to the cut, then from their marks on, then once more."""
    path, out = fresh_dir(spark, "control"), fresh_dir(spark, "topic")
    lines = X.lines(spark, d, faults=True)
    feeds = {name: replace(X.FEED, feed=name, topic=name) for name in ("even", "odd")}
    letters = {name: Letters(spark, fresh_dir(spark, "letters")) for name in feeds}

    def fetch(name: str, rows: DataFrame, meanwhile=None) -> None:
        own = rows.filter(F.col("event_id") % 2 == (0 if name == "even" else 1))

        def publish(messages: DataFrame) -> None:
            topic.publish(messages, feeds[name], f"{out}/{name}")
            if meanwhile is not None:
                meanwhile()

        intake.run(spark, feeds[name], own, path, letters[name], publish)

    before = lines.filter(F.col("ts") < X.moment(X.CUT))
    fetch("even", before, lambda: fetch("odd", before))
    for rows in (lines, lines):
        fetch("even", rows)
        fetch("odd", rows)
    marks = watermark.marks(control.read(spark, path))
    sent = [_published(spark, f"{out}/{name}").withColumn("feed_name", F.lit(name)) for name in feeds]
    put = [
        letters[name].read().agg(F.count("*").alias("letters"), F.sum("puts").alias("puts")).withColumn("feed_name", F.lit(name))
        for name in feeds
    ]
    return sent[0].unionByName(sent[1]).join(marks, "feed_name").join(put[0].unionByName(put[1]), "feed_name")


@query
def intake_fetch(spark, d):
    """A folder of feed files: fetched, fetched again unchanged, letters purged, a file with known lines added, fetched once more."""
    feed_path, path, out = (fresh_dir(spark, label) for label in ("feed", "control", "topic"))
    letters = Letters(spark, fresh_dir(spark, "letters"))
    lines = X.lines(spark, d, faults=True)
    lines.repartition(_FILES, "event_id").select("line").write.text(f"{feed_path}/first")

    def fetch():
        return intake.fetch(spark, X.FEED, feed_path, path, letters, lambda m: topic.publish(m, X.FEED, out))

    results = [fetch(), fetch()]
    open_before = letters.read().count()
    deadletters.purge(letters, fresh_dir(spark, "alerts"))
    lines.filter(F.col("event_id") % 3 == 0).select("line").coalesce(1).write.text(f"{feed_path}/second")
    results.append(fetch())
    rows = [(f"files_{k}", r.files) for k, r in enumerate(results, 1)] + [(f"read_{k}", r.read) for k, r in enumerate(results, 1) if k > 1]
    rows += [("published", sum(r.published for r in results)), ("letters", open_before), ("letters_after", letters.read().count())]
    rows.append(("puts", letters.log().filter(F.col("reason") != deadletter.PURGED).agg(F.sum("puts").alias("n")).first()["n"]))
    return spark.createDataFrame(rows, "metric string, n bigint")


# ---------------------------------------------------------------- schema history


@query
def registry_latest(spark, d):
    return _versions(contract.latest(X.schema_history(spark, d)))


@query
def registry_register(spark, d):
    return _versions(contract.register(X.schema_history(spark, d), X.new_schemas(spark, d)))


@query
def registry_update(spark, d):
    return _versions(contract.replace(X.schema_history(spark, d), X.new_schemas(spark, d)))


# ---------------------------------------------------------------- delivery and streams


@query
def delivery_report(spark, d):
    report = audit.delivery_report(audit.deliveries(X.messages(spark, d)))
    return report.withColumn("partition", F.col("partition").cast("bigint"))


@query
def delivery_log(spark, d):
    """Reports of an intake in three batches, two of them while the topic is down and one of these run again, and of two replays.

    Per batch and status: messages, error, partitions, and those whose number and highest offset are not what the topic holds.
    """
    cfg, out = X.FEED, fresh_dir(spark, "topic")
    letters, report = Letters(spark, fresh_dir(spark, "letters")), DeliveryLog(spark, fresh_dir(spark, "report"))
    lines = _with_values(spark, d)
    early, late = F.col("ts") < X.moment(X.CUT), F.col("ts") >= X.moment(X.BROKER_DOWN)

    def up(messages: DataFrame) -> DataFrame:
        return topic.publish(messages, cfg, out)

    # comes twice, so it is stored as it was classified
    again = lines.filter(~early & ~late).select(*intake.CHECKED).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for name, part, sink in (("intake-0", lines.filter(early), up), ("intake-1", again, _down), ("intake-2", lines.filter(late), _down), ("intake-1", again, up)):
            intake.deliver(cfg, part, letters, sink, name, report=report)
    finally:
        again.unpersist()
    for sink in (_down, up):
        deadletters.replay(letters, cfg, sink, report=report)
    held = spark.read.schema(topic.MESSAGE_SCHEMA).parquet(out).groupBy("partition", F.input_file_name().alias("file"))
    batch = F.element_at(F.split("file", "/"), -2).alias("held_in")
    held = held.agg(F.count("*").alias("n"), F.max("offset").alias("max_offset")).groupBy(batch, "partition").agg(
        F.sum("n").alias("n"), F.max("max_offset").alias("max_offset"), F.lit(0).cast("bigint").alias("differ")
    )
    rows = report.read().withColumn("delivery", F.when(F.col("name").contains("-replay-"), "replay").otherwise(F.col("name")))
    differ = F.when(F.col("status") == "failed", F.when(F.col("max_offset").isNull(), 0).otherwise(1)).otherwise(F.coalesce("differ", F.lit(1)))
    return rows.join(held.drop("held_in"), ["partition", "n", "max_offset"], "left").groupBy("delivery", "status").agg(
        F.sum("n").alias("n"), F.max("error").alias("error"), F.countDistinct("partition").alias("partitions"), F.sum(differ).cast("bigint").alias("differ")
    )


@query
def landing_accounts(spark, d):
    """Messages with errors and ends of partitions among them through the landing job, which dies in its second batch and is started again.

    Per partition: what was read, by its fate, and the offset committed; from the sinks themselves the rows that landed and the letters of errors.
    """
    cfg = X.FEED
    source, raw, state = (fresh_dir(spark, label) for label in ("topic", "raw", "checkpoint"))
    letters, accounts = Letters(spark, fresh_dir(spark, "letters")), Accounts(spark, fresh_dir(spark, "accounts"))
    files = _write_in_files(X.relayed_messages(spark, d), "offset", source)
    dies = X.DiesOnce(accounts, "put")

    def attempt():
        stream = topic.subscribe(spark, cfg, source, max_files=_third(files), errors="error")
        jobs.start_landing(stream, cfg, raw, letters, state, drain=True, errors="error", accounts=dies).awaitTermination()

    X.restarted(attempt)
    accounts.compact()
    landed = rawzone.read(spark, raw, landing.raw_schema(spark, cfg)).groupBy(F.col("msg_partition").alias("partition")).agg(F.count("*").alias("raw_rows"))
    of = F.get_json_object("raw", "$.msg_partition").cast("int").alias("partition")
    lost = letters.read().filter(F.col("reason") == envelope.MESSAGE_ERROR).groupBy(of).agg(F.sum("puts").alias("error_letters"))
    report = accounts.report().join(landed, "partition", "left").join(lost, "partition", "left")
    return report.withColumn("partition", F.col("partition").cast("bigint")).na.fill(0, ["raw_rows", "error_letters"])


@query
def commit_progress(spark, d):
    """A stream that dies inside its second batch, after it has written, and is started again."""
    sent = X.messages(spark, d)
    source, out, state = (fresh_dir(spark, label) for label in ("messages", "committed", "checkpoint"))
    files = _write_in_files(sent, "offset", source)
    failures = [ConnectionError("executor lost")]

    def write(rows: DataFrame, number: int) -> None:
        progress.write_batch(rows, number, out)
        if number == 1 and failures:
            raise failures.pop()

    def attempt():
        stream = spark.readStream.schema(sent.schema).option("maxFilesPerTrigger", _third(files)).parquet(source)
        jobs.start(stream, write, X.FEED, state, drain=True).awaitTermination()

    try:
        attempt()
    except Exception as failure:  # noqa: BLE001 - as Spark reports it
        if "executor lost" not in str(failure):
            raise
        attempt()
    return progress.committed(spark.read.schema(sent.schema).parquet(out)).withColumn(
        "partition", F.col("partition").cast("bigint")
    )


@query
def stream_raw_ingest(spark, d):
    """Messages with all faults through topic, checks and flatten into the raw zone."""
    cfg = X.FEED
    source, raw, letters, state = (fresh_dir(spark, label) for label in ("topic", "raw", "letters", "checkpoint"))
    files = _write_in_files(X.faulty_messages(spark, d), "offset", source)
    stream = topic.subscribe(spark, cfg, source, max_files=_third(files))
    jobs.start_landing(stream, cfg, raw, Letters(spark, letters), state, drain=True).awaitTermination()
    return rawzone.read(spark, raw, landing.raw_schema(spark, cfg)).select("id", "v", "op", "ts_us", "msg_offset")


@query
def landing_restart(spark, d):
    """As above, but the job dies in its second batch after both sinks have it, and is started again."""
    cfg = X.FEED
    source, raw, letters, state = (fresh_dir(spark, label) for label in ("topic", "raw", "letters", "checkpoint"))
    files = _write_in_files(X.faulty_messages(spark, d), "offset", source)
    dead = X.DiesOnce(Letters(spark, letters), "put")

    def attempt():
        stream = topic.subscribe(spark, cfg, source, max_files=_third(files))
        jobs.start_landing(stream, cfg, raw, dead, state, drain=True).awaitTermination()

    X.restarted(attempt)
    landed = rawzone.read(spark, raw, landing.raw_schema(spark, cfg)).select(F.lit("ok").alias("reason"), F.lit(1).cast("bigint").alias("n"))
    put = dead.read().select("reason", F.col("puts").alias("n"))
    return landed.unionByName(put).groupBy("reason").agg(F.sum("n").alias("n"))


@query
def stream_dedupe(spark, d):
    """A topic that brings messages again, in the same micro-batch, in a later one, and after a restart."""
    cfg = X.FEED
    source, raw, letters, state = (fresh_dir(spark, label) for label in ("topic", "raw", "letters", "checkpoint"))
    sent = X.faulty_messages(spark, d)
    again = sent.withColumn("offset", F.col("offset") + 1_000_000_000)
    for part in (sent.filter(F.col("offset") % 2 == 0), again.filter(F.col("offset") % 4 == 0), sent.filter(F.col("offset") % 3 == 0), sent):
        _write_in_files(part.unionByName(part.filter(F.col("offset") % 5 == 0)), "offset", source, mode="append")
        stream = topic.subscribe(spark, cfg, source, max_files=2)
        jobs.start_landing(stream, cfg, raw, Letters(spark, letters), state, drain=True, once_within="60 days").awaitTermination()
    rows = rawzone.read(spark, raw, landing.raw_schema(spark, cfg))
    return rows.groupBy("id", "ts_us").agg(F.count("*").alias("n"))


@query
def merge_restart(spark, d):
    """A merge that dies in its second batch after it is written, and is started again."""
    log = X.slot_changes(spark, d)
    raw, state = fresh_dir(spark, "raw"), fresh_dir(spark, "checkpoint")
    files = _write_in_files(log, "seq", raw)
    target = X.DiesOnce(_slots_target(spark, log), "add")

    def attempt():
        stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", _third(files)).parquet(raw)
        jobs.start_merge(stream, X.FEED, target, state, drain=True).awaitTermination()

    X.restarted(attempt)
    return target.rows()


@query
def stream_merge(spark, d):
    """The raw zone as a stream of out-of-order files, appended batch by batch, with a daily rewrite."""
    log = X.slot_changes(spark, d)
    raw, state = fresh_dir(spark, "raw"), fresh_dir(spark, "checkpoint")
    # every file has rows of all times, as landed on the day after the last of them
    landed = log.withColumn(rawzone.DAY, F.to_date(F.lit("2024-02-01"))).repartition(_FILES, "seq")
    rawzone.write(landed, raw, many_days=False)
    target = _slots_target(spark, log)
    merging.merge_changes(target, log.filter(F.col("ts") < X.moment(X.CUT)), "2024-01-15")
    stream = rawzone.stream(spark, raw, log.schema, max_files=_third(_FILES)).drop(rawzone.DAY)
    jobs.start_merge(stream, X.FEED, target, state, drain=True).awaitTermination()
    merging.compact(target, "2024-02-01")
    return target.rows()


@query
def registry_stored(spark, d):
    """The stored history: registered, registered again, superseded for every part; with what was retired."""
    path = fresh_dir(spark, "registry")
    registry.register(spark, path, X.new_schemas(spark, d))
    registry.register(spark, path, X.new_schemas(spark, d))
    parts = X.new_schemas(spark, d).filter(F.col("subject").startswith("part"))
    added, retired = registry.replace(spark, path, parts.withColumn("schema_json", F.lit('{"v":99}')))
    done = added.withColumn("what", F.lit("added")).unionByName(retired.withColumn("what", F.lit("retired")))
    return _versions(registry.read(spark, path)).join(done.select("subject", F.col("version").cast("bigint").alias("version"), "what"), ["subject", "version"], "left")


# ---------------------------------------------------------------- shared parts


def _classified(spark, d) -> DataFrame:
    return envelope.classify(X.lines(spark, d, faults=True), X.FEED.keys, X.LINE_SCHEMA)


def _control(spark, d) -> DataFrame:
    """Marks as they stood at the cut."""
    before = X.table(spark, d, "events").filter(F.col("ts") < X.moment(X.CUT))
    return before.select(F.col("event_type").alias("feed_name"), clock.micros("ts").alias("last_upd"))


def _raw_events(spark, d) -> tuple[str, T.StructType]:
    log = X.changelog(spark, d)
    path = fresh_dir(spark, "raw")
    rawzone.write(log.withColumn(rawzone.DAY, F.to_date("ts")), path)
    return path, log.schema


def _slots_target(spark, log: DataFrame) -> Target:
    return Target(spark, fresh_dir(spark, "target"), log.schema, tuple(X.SLOT_KEYS), tuple(X.ORDER))


def _folder_target(spark, d, by: str) -> folders.FolderTarget:
    return folders.FolderTarget(spark, fresh_dir(spark, "folders"), X.slot_changes(spark, d).schema, tuple(X.SLOT_KEYS), tuple(X.ORDER), by)


def _with_values(spark, d) -> DataFrame:
    return envelope.classify(X.lines(spark, d, faults=True), X.FEED.keys, X.LINE_SCHEMA, with_value=True)


def _down(messages: DataFrame) -> None:
    raise ConnectionError("topic is not available")


def _published(spark, folder: str) -> DataFrame:
    """What consumers find on a folder topic: key, event time, and how often."""
    sent = spark.read.schema(topic.MESSAGE_SCHEMA).parquet(folder)
    field = lambda c, path: F.get_json_object(F.col(c).cast("string"), path)
    return sent.groupBy(field("key", "$.id").alias("id"), field("value", "$.ts_us").cast("bigint").alias("ts_us")).agg(
        F.count("*").alias("n")
    )


def _letters_by_record(spark, d) -> DataFrame:
    """Faulty lines, and good ones from the time the broker was down, by record key."""
    rows = _classified(spark, d)
    lost = (F.col("reason") == envelope.OK) & (F.col("ts") >= X.moment(X.BROKER_DOWN))
    letters = rows.filter(lost | ~F.col("reason").isin(envelope.OK, envelope.BLANK))
    key = deadletter.record_key("line", "key_text")
    return deadletter.state(deadletter.puts(letters, "line", key, _undelivered_if_ok(), F.col("ts").cast("timestamp")))


def _stored_letters(spark, d) -> Letters:
    """The same by message, checked for their envelope only, in a store."""
    rows = envelope.classify_envelope(X.lines(spark, d, faults=True)).filter(F.col("reason") != envelope.BLANK)
    key = deadletter.message_key("line")
    letters = Letters(spark, fresh_dir(spark, "letters"))
    letters.put(deadletter.puts(rows, "line", key, _undelivered_if_ok(), F.col("ts").cast("timestamp")))
    return letters


def _undelivered_if_ok() -> Column:
    return F.when(F.col("reason") == envelope.OK, envelope.UNDELIVERED).otherwise(F.col("reason"))


def _letter_counts(letters: DataFrame) -> DataFrame:
    return letters.groupBy("reason").agg(
        F.count("*").alias("n"), F.sum("attempts").cast("bigint").alias("attempts"), F.sum("puts").alias("puts")
    )


def _versions(rows: DataFrame) -> DataFrame:
    text = [F.col(f.name).cast("string").alias(f.name) if f.name == "retired" else F.col(f.name) for f in rows.schema]
    return rows.select(*text).withColumn("version", F.col("version").cast("bigint"))


_FILES = 6


def _write_in_files(rows: DataFrame, key: str, folder: str, mode: str = "error") -> int:
    """Writes rows in about six files, each with rows from all times; returns how many there are."""
    rows.repartition(_FILES, key).write.mode(mode).parquet(folder)
    return len(rows.sparkSession.read.schema(rows.schema).parquet(folder).inputFiles())


def _third(files: int) -> int:
    """Files per micro-batch for about three batches."""
    return -(-files // 3)
