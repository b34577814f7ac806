"""Publishing in chunks, retries of the failed subset, dead letters and replay.

A ledger holds one row per record and attempt. It is the single truth: the
summary, the dead letters and the warnings are all read off it. Rows are keyed
by ``batch_id, chunk_index, position``, since event ids may repeat.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import reduce
from operator import xor

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanflow.functions.json import field, strict_str, with_document
from spanflow.functions.retry import (
    BASE_BACKOFF_MS,
    COUNT_MISMATCH,
    JITTER_MS,
    MAX_ATTEMPTS,
    MAX_BACKOFF_DOUBLINGS,
    MAX_BACKOFF_MS,
    RETRY_FLOOR_MS,
    RETRYABLE_CODES,
    base_backoff_ms,
    epoch_millis,
    has_retry_budget,
    is_retryable_error,
    jitter_ms,
)
from spanflow.plans.partition import DEAD_LETTER_CHUNK

CHUNK = ["batch_id", "chunk_index"]
ROW = [*CHUNK, "position"]
FAILURE_KIND = "kinesis_publish_failure"

PUBLISHED, RETRIED, DEAD = "published", "retried", "dead"

# What a dead letter holds of its record.
LETTER_FIELDS = ["trace_id", "source_log_group", "message"]
LEDGER = (
    "batch_id bigint, chunk_index bigint, position bigint, source_event_id string,"
    " attempt bigint, error_code string, error_message string, outcome string"
)


def publish_ledger(outcomes: DataFrame) -> DataFrame:
    """Which attempts happen, given what each one would answer.

    ``outcomes`` has, per record and attempt, the ``source_event_id``,
    ``error_code`` (null for success), ``error_message``, ``budget_ms`` left at that time and, if the caller knows
    better than the code list, ``retryable``. An attempt happens when all the
    earlier ones failed in a way that is retried.
    """
    if "retryable" not in outcomes.columns:
        outcomes = outcomes.withColumn("retryable", is_retryable_error(F.col("error_code")))
    again = (
        F.col("error_code").isNotNull()
        & F.col("retryable")
        & has_retry_budget(F.col("budget_ms"))
        & (F.col("attempt") < MAX_ATTEMPTS)
    )
    earlier = Window.partitionBy(*ROW).orderBy("attempt").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        outcomes.withColumn("_again", again)
        .withColumn("_reached", F.coalesce(F.min("_again").over(earlier), F.lit(True)))
        .where("_reached")
        .withColumn(
            "outcome",
            F.when(F.col("error_code").isNull(), PUBLISHED)
            .when(F.col("_again"), RETRIED)
            .otherwise(DEAD),
        )
        .select(
            *ROW, "source_event_id", F.col("attempt").cast("bigint").alias("attempt"),
            "error_code", "error_message", "outcome",
        )
    )


def publish_with_retry(
    requests: DataFrame,
    put: Callable[[pd.DataFrame, int], pd.DataFrame],
    budget_ms: Callable[[], float] = lambda: float("inf"),
    pause: Callable[[float], None] | None = None,
    columns: list[str] | None = None,
    together: bool = False,
    letters: bool = False,
    live: list[str] | None = None,
) -> DataFrame:
    """Send every chunk through ``put`` and return the ledger.

    ``put(chunk, attempt)`` gets the pending rows and returns ``error_code`` and
    ``error_message`` row by row in the same order (null code for success), plus
    ``retryable`` if it knows better. A call that raises fails all its rows with
    the exception's name as code, and so does a wrong number of rows.

    ``put`` sees the position, the event id and ``columns``; by default all of them
    but the parsed record. A chunk has a bounded number of rows and is one group. With
    ``together`` the rows of a chunk must stand one after the other in their partition, as
    ``partition_batches`` leaves them; then nothing is shuffled to bring them together.
    With ``letters`` the ledger carries what a dead letter needs of each record that fails
    for good, so that ``dead_letters`` makes the records no second time to look it up.
    The columns of ``live``, texts, are carried by the last attempt of every record, whether
    it got through or not (``requests_of``, ``delivered``).
    Before another attempt ``pause`` gets the seconds to wait, with a jitter that
    follows from the ids to send again. A lost task repeats
    its calls, so ``put`` must accept a record twice; write the ledger out
    before reading it for routing.
    """

    live = live or []
    failing = [name for name in LETTER_FIELDS if letters and name not in live]
    carried = [*failing, *live]
    schema = ", ".join([LEDGER, *[f"{name} string" for name in carried]])

    def call(pending: pd.DataFrame, attempt: int) -> pd.DataFrame:
        try:
            answer = put(pending, attempt).reset_index(drop=True)
        except Exception as error:  # noqa: BLE001
            code = getattr(error, "code", None) or type(error).__name__
            answer = pd.DataFrame(
                {"error_code": [code] * len(pending), "error_message": str(error)}
            )
        if len(answer) != len(pending):
            message = f"sent {len(pending)} records, answers: {len(answer)}"
            answer = pd.DataFrame(
                {
                    "error_code": [COUNT_MISMATCH] * len(pending),
                    "error_message": message,
                    "retryable": True,
                }
            )
        if "retryable" not in answer:
            answer["retryable"] = answer["error_code"].isin(RETRYABLE_CODES)
        return answer

    def attempts(chunk: pd.DataFrame) -> list[tuple]:
        """Per attempt of a chunk: its rows by place, number, codes, messages and outcomes."""
        place = np.arange(len(chunk))
        if not chunk["position"].is_monotonic_increasing:
            place = np.argsort(chunk["position"].to_numpy())
            chunk = chunk.iloc[place]
        pending, at, done = chunk.reset_index(drop=True), np.arange(len(chunk)), []
        for attempt in range(1, MAX_ATTEMPTS + 1):
            answer = call(pending, attempt)
            code = answer["error_code"]
            failed = code.notna().to_numpy()
            again = failed & answer["retryable"].astype(bool).to_numpy()
            if attempt == MAX_ATTEMPTS or budget_ms() < RETRY_FLOOR_MS:
                again[:] = False
            outcome = np.where(again, RETRIED, np.where(failed, DEAD, PUBLISHED)).astype(object)
            numbers = np.full(len(at), attempt)
            done.append((place[at], numbers, code.to_numpy(object), answer["error_message"].to_numpy(object), outcome))
            at = at[again]
            if not len(at):
                break
            pending = pending[again].reset_index(drop=True)
            if pause is not None:
                base = min(BASE_BACKOFF_MS * 2 ** min(attempt - 1, MAX_BACKOFF_DOUBLINGS), MAX_BACKOFF_MS)
                jitter = reduce(xor, (zlib.crc32(i.encode()) for i in pending["source_event_id"]), 0) % JITTER_MS
                pause((base + jitter) / 1000)
        return done

    def publish_rows(rows: pd.DataFrame, starts: list[int]) -> pd.DataFrame:
        """The ledger of rows whose chunks begin at ``starts``, put together once for all of them."""
        done = []
        for start, end in zip(starts, [*starts[1:], len(rows)], strict=True):
            done += [(start + place, *rest) for place, *rest in attempts(rows.iloc[start:end])]
        place, number, code, message, outcome = (np.concatenate(parts) for parts in zip(*done, strict=True))
        found = {name: rows[name].to_numpy()[place] for name in [*ROW, "source_event_id"]}
        for name in carried:
            value = rows[name].to_numpy(object)[place]
            value[outcome == RETRIED if name in live else outcome != DEAD] = None
            found[name] = value
        return pd.DataFrame({**found, "attempt": number, "error_code": code, "error_message": message, "outcome": outcome})

    def publish_chunk(chunk: pd.DataFrame) -> pd.DataFrame:
        return publish_rows(chunk, [0])

    wanted = columns if columns is not None else [c for c in requests.columns if c != "record"]
    needed = list(dict.fromkeys([*ROW, "source_event_id", *wanted, *carried]))

    def publish_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # The last chunk of a batch may go on in the next one.
        rest = None
        for batch in batches:
            if batch.empty:
                continue
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            starts = np.zeros(len(rows), dtype=bool)
            starts[0] = True
            for name in CHUNK:
                key = rows[name].to_numpy()
                starts[1:] |= key[1:] != key[:-1]
            *first, last = np.flatnonzero(starts).tolist()
            if first:
                yield publish_rows(rows.iloc[:last], first)
            rest = rows.iloc[last:].reset_index(drop=True)
        if rest is not None:
            yield publish_chunk(rest)

    if together:
        return requests.select(*needed).mapInPandas(publish_all, schema)
    return requests.select(*needed).groupBy(*CHUNK).applyInPandas(publish_chunk, schema)


def response_zip_join(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Pair requests and responses of one attempt by position.

    A chunk whose counts differ has no valid pairing: all its rows fail with the
    count-mismatch code, which is retried.
    """
    sent = requests.groupBy(*CHUNK).agg(F.count(F.lit(1)).alias("_sent"))
    got = responses.groupBy(*CHUNK).agg(F.count(F.lit(1)).alias("_got"))
    sizes = sent.join(got, CHUNK, "left").withColumn(
        "_got", F.coalesce("_got", F.lit(0))
    )
    wrong = F.col("_sent") != F.col("_got")
    message = F.concat(
        F.lit("sent "), F.col("_sent").cast("string"),
        F.lit(" records, answers: "), F.col("_got").cast("string"),
    )
    return (
        requests.join(responses.select(*ROW, "error_code", "error_message"), ROW, "left")
        .join(sizes, CHUNK)
        .withColumns(
            {
                "error_code": F.when(wrong, COUNT_MISMATCH).otherwise(F.col("error_code")),
                "error_message": F.when(wrong, message).otherwise(F.col("error_message")),
                "retryable": wrong | is_retryable_error(F.col("error_code")),
            }
        )
        .drop("_sent", "_got")
    )


def request_failure_fanout(requests: DataFrame, failed_chunks: DataFrame) -> DataFrame:
    """A failed request marks every row of its chunk with the request's error."""
    return requests.join(
        failed_chunks.select(*CHUNK, "attempt", "error_code", "error_message"), CHUNK
    )


def failed_subset_join(requests: DataFrame, ledger: DataFrame, attempt: int) -> DataFrame:
    """Only the records that ``attempt`` failed in a way that is retried."""
    failed = ledger.where((F.col("attempt") == attempt) & (F.col("outcome") == RETRIED))
    return requests.join(failed, ROW, "left_semi")


def split_failures(ledger: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Failed attempts as (retried, dead)."""
    return (
        ledger.where(F.col("outcome") == RETRIED),
        ledger.where(F.col("outcome") == DEAD),
    )


def requests_of(ledger: DataFrame) -> DataFrame:
    """One row for each record that was sent, with its columns of ``live``: its last attempt."""
    return ledger.where(F.col("outcome") != RETRIED)


def delivered(ledger: DataFrame) -> DataFrame:
    """The rows of ``requests_of`` whose record got through."""
    return ledger.where(F.col("outcome") == PUBLISHED)


def recovered_ids(ledger: DataFrame) -> DataFrame:
    """Event ids that a later attempt of some chunk sent without a failure."""
    return (
        ledger.where(F.col("attempt") > 1)
        .groupBy(*CHUNK, "attempt", "source_event_id")
        .agg(F.max(F.col("outcome") != PUBLISHED).alias("failed"))
        .where(~F.col("failed"))
        .select("source_event_id")
        .distinct()
    )


def retry_delays(ledger: DataFrame) -> DataFrame:
    """Per chunk and attempt that is retried: rows to retry and the wait before it."""
    retried, _ = split_failures(ledger)
    return (
        retried.groupBy(*CHUNK, "attempt")
        .agg(
            F.count(F.lit(1)).alias("failed_records"),
            jitter_ms(F.col("source_event_id")).alias("jitter_ms"),
        )
        .withColumn("base_ms", base_backoff_ms(F.col("attempt")))
        .withColumn("delay_ms", F.col("base_ms") + F.col("jitter_ms"))
    )


def retry_budgets(delays: DataFrame, limit_ms: Column) -> DataFrame:
    """What the waits leave of a chunk's time limit, and whether another attempt is worth it.

    ``delays`` are rows of ``retry_delays``. The jitter is not counted, so the answer
    depends on the limit and the number of attempts alone.
    """
    waits = Window.partitionBy(*CHUNK).orderBy("attempt")
    return delays.withColumn("budget_ms", limit_ms - F.sum("base_ms").over(waits)).withColumn(
        "again", has_retry_budget(F.col("budget_ms"))
    )


def unsent_letters(results: DataFrame) -> int:
    """How many dead letters ``send_dead_letters`` could not send."""
    return results.agg(F.coalesce(F.sum("failed"), F.lit(0))).first()[0]


def publish_summary(ledger: DataFrame, failure_queue_send_failures: int = 0) -> DataFrame:
    """One row of counters over a whole ledger; ``unsent_letters`` counts failed sends.

    Ids are counted once however often they were retried. All steps aggregate
    before they shuffle.
    """
    calls = ledger.groupBy(*CHUNK, "attempt", "source_event_id").agg(
        F.count_if(F.col("outcome") == PUBLISHED).alias("published"),
        F.count_if(F.col("outcome") == RETRIED).alias("retried"),
        F.count_if(F.col("outcome") == DEAD).alias("dead"),
    )
    recovered = (F.col("attempt") > 1) & (F.col("retried") + F.col("dead") == 0)
    # One pass counts both per event id and per chunk, where the calls made are
    # as many as the highest attempt.
    both = calls.groupingSets(
        [["source_event_id"], CHUNK], "source_event_id", *CHUNK
    ).agg(
        F.grouping("source_event_id").alias("by_chunk"),
        F.max("attempt").alias("attempts"),
        F.sum("published").alias("published"),
        F.sum("dead").alias("dead"),
        F.max(F.col("retried") > 0).alias("was_retried"),
        F.max(recovered).alias("was_recovered"),
    )
    by_id = F.col("by_chunk") == 0

    def total(column: str, condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0)).cast("bigint")

    return both.agg(
        total("published", by_id).alias("published_records"),
        F.count_if(by_id & F.col("was_retried")).alias("retried_records"),
        F.count_if(by_id & F.col("was_recovered")).alias("recovered_on_retry"),
        total("dead", by_id).alias("sent_to_failure_queue"),
        F.lit(failure_queue_send_failures).cast("bigint").alias("failure_queue_send_failures"),
        total("attempts", ~by_id).alias("publish_attempts"),
    )


def dead_letters(ledger: DataFrame, requests: DataFrame | None, stream_name: str) -> DataFrame:
    """Failure envelopes, each with the whole message so that it can be replayed. Where the
    ledger does not carry it (``letters``), it is looked up in ``requests``."""
    _, dead = split_failures(ledger)
    if not set(LETTER_FIELDS) <= set(ledger.columns):
        dead = dead.drop("source_event_id").join(requests, ROW)
    return dead.select(
        *ROW,
        F.lit(FAILURE_KIND).alias("kind"),
        F.lit(stream_name).alias("stream_name"),
        F.col("trace_id").alias("partition_key"),
        "source_event_id",
        "trace_id",
        "source_log_group",
        F.col("message").alias("record"),
        F.col("attempt").alias("attempt_count"),
        F.col("error_code").alias("last_error_code"),
        F.coalesce("error_message", F.lit("")).alias("last_error_message"),
        epoch_millis().alias("failed_at"),
    )


def chunk_failures(letters: DataFrame, size: int = DEAD_LETTER_CHUNK) -> DataFrame:
    """Dead letters in groups of ``size`` inside their chunk (at most 500 rows)."""
    order = Window.partitionBy(*CHUNK).orderBy("attempt_count", "position")
    return letters.withColumn(
        "send_index", F.floor((F.row_number().over(order) - 1) / size).cast("bigint")
    )


def dead_letter_json(letters: DataFrame) -> DataFrame:
    """Add ``value``, the envelope as JSON; the record is spliced in as it came."""
    names = [c for c in letters.columns if c not in (*ROW, "record", "send_index")]
    rest = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    record = F.coalesce("record", F.lit("null"))
    return letters.withColumn("value", F.concat(F.lit('{"record":'), record, F.lit(","), F.substr(rest, F.lit(2))))


def write_dead_letters(letters: DataFrame, path: str) -> None:
    """Append envelopes as lines of JSON, gzip files; a failed write fails the job."""
    dead_letter_json(letters).select("value").write.mode("append").text(path, compression="gzip")


def send_dead_letters(letters: DataFrame, send: Callable[[list[str]], int]) -> DataFrame:
    """Call ``send`` with the envelopes of each group of ``chunk_failures``.

    It returns how many of them failed; a call that raises fails all. The result has a
    row for each group, with ``sent`` and ``failed``. Write it out, then call
    ``require_sent`` on it.
    """
    grouped = dead_letter_json(letters).groupBy(*CHUNK, "send_index").agg(
        F.array_sort(F.collect_list(F.struct("attempt_count", "position", "value"))).alias("found")
    ).select(*CHUNK, "send_index", F.transform("found", lambda x: x["value"]).alias("values"))

    def call(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            failed = []
            for values in batch["values"]:
                try:
                    failed.append(int(send(list(values))))
                except Exception:  # noqa: BLE001
                    failed.append(len(values))
            sizes = batch["values"].map(len)
            yield batch[[*CHUNK, "send_index"]].assign(sent=sizes - failed, failed=failed)

    schema = grouped.drop("values").schema.add("sent", "long").add("failed", "long")
    return grouped.mapInPandas(call, schema)


def require_sent(results: DataFrame) -> int:
    """The number of dead letters sent; fails the job if any was not."""
    row = results.agg(F.coalesce(F.sum("sent"), F.lit(0)).alias("sent"), F.coalesce(F.sum("failed"), F.lit(0)).alias("failed")).first()
    if row.failed:
        raise RuntimeError(f"{row.failed} of {row.sent + row.failed} dead letters could not be sent")
    return row.sent


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """Lines that ``write_dead_letters`` wrote, ``value`` each."""
    return spark.read.text(path)


def replay_dead_letters(letters: DataFrame) -> DataFrame:
    """Envelopes (``value``) back to keyed records, ready to join the live ones."""
    doc = F.col("_letter")
    record = F.when(field(doc, "$.record").isNotNull(), field(doc, "$.record"))
    return with_document(letters.select("value"), F.col("value"), "_letter").select(
        strict_str(doc, "$.source_log_group").alias("source_log_group"),
        strict_str(doc, "$.source_event_id").alias("source_event_id"),
        strict_str(doc, "$.trace_id").alias("trace_id"),
        F.to_json(record).alias("message"),
        record.alias("record"),
    )
