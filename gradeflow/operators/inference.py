"""The model call: the only Python boundary in the engine.

``batch_chat`` sends each row's message list to a user ``chat`` callable inside
``mapInArrow`` (Arrow record batches; key columns pass through unconverted).
Spark tasks give the parallelism; a sliding window of calls inside a task overlaps
I/O-bound ones, across batches: a slow call holds up no other, and the window narrows
when the model's limit is hit. Retries are bounded: after
``max_attempts`` the row carries the error instead of a response, so one bad row
never stalls a job. The output must be materialised before it feeds more than
one action, or the calls run again (see ``gradeflow.sources.io.materialize``).

``call_in_rounds`` retries without waiting inside a task: what failed goes to a table of
due times and is tried again by a later job.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed_values import BAD_REQUEST_TEXT
from ..session import scratch_path


def retry_any(exc: BaseException) -> bool:
    """Retry on any error."""
    return True


def retry_rate_limit(exc: BaseException) -> bool:
    """Retry only when the error message mentions a limit (rate limiting)."""
    return "limit" in str(exc).lower()


def bad_request_fallback(exc: BaseException) -> str | None:
    """A bad request becomes a fixed reply text, scored like any answer."""
    return BAD_REQUEST_TEXT if type(exc).__name__ == "BadRequestError" else None


def no_fallback(exc: BaseException) -> str | None:
    return None


class CallPolicy:
    """How one call is retried: attempts, back-off, and which errors are retried."""

    def __init__(
        self,
        max_attempts: int = 3,
        backoff_base: float = 2.0,
        max_backoff: float = 60.0,
        retryable: Callable[[BaseException], bool] = retry_any,
        fallback: Callable[[BaseException], str | None] = no_fallback,
    ):
        if max_attempts < 1:
            raise ValueError("max_attempts must be at least 1")
        self.max_attempts = max_attempts
        self.backoff_base = backoff_base
        self.max_backoff = max_backoff
        self.retryable = retryable
        self.fallback = fallback

    def attempt(self, chat: Callable, messages: list[dict]) -> tuple[str | None, str | None, BaseException | None]:
        """One try: (response, error, the exception if it may be tried again)."""
        try:
            out = chat(messages)
            text = getattr(out, "response_text", out)
            if text is None:
                raise ValueError("chat returned no text")
            return str(text), None, None
        except Exception as exc:  # noqa: BLE001 - every failure becomes data
            fb = self.fallback(exc)
            if fb is not None:
                return fb, None, None
            return None, str(exc) or type(exc).__name__, exc if self.retryable(exc) else None

    def delay(self, attempt: int) -> float:
        """Seconds to wait after so many failed attempts."""
        return min(self.backoff_base ** (attempt - 1), self.max_backoff) if self.backoff_base > 0 else 0.0

    def call(self, chat: Callable, messages: list[dict], failed: Callable[[BaseException], None] | None = None) -> tuple[str | None, str | None, int]:
        """(response, error, attempts) for one message list; ``failed`` hears of every error
        that is tried again."""
        for n in range(1, self.max_attempts + 1):
            response, error, again = self.attempt(chat, messages)
            if again is None or n == self.max_attempts:
                break
            if failed:
                failed(again)
            time.sleep(self.delay(n))
        return response, error, n


def _as_messages(value) -> list[dict]:
    """Arrow list<struct> value as ``[{role, content, ...}]`` without null fields."""
    if value is None:
        return []
    return [{k: v for k, v in m.items() if v is not None} for m in value]


def batch_chat(
    df: DataFrame,
    chat: Callable[[list[dict]], str] | dict[str, Callable[[list[dict]], str]],
    key_cols: Sequence[str],
    messages_col: str = "messages",
    model_col: str | None = None,
    policy: CallPolicy | None = None,
    concurrency: int = 1,
    num_partitions: int | None = None,
) -> DataFrame:
    """``(key..., response, error, attempts)`` for every input row.

    ``key_cols`` are carried through unchanged (they need not be unique: every
    input row is one call).

    ``num_partitions`` spreads the calls evenly (round-robin repartition); without
    it the calls run in the input's own partitions, and building the plan runs no job.
    ``concurrency`` > 1 runs that many calls at once inside each task.
    """
    policy = policy or CallPolicy()
    keys = list(key_cols)
    if isinstance(chat, dict):
        if not model_col or model_col not in keys:
            raise ValueError("a dict of chat functions needs model_col among key_cols")
    src = df.select(*keys, messages_col)
    if num_partitions:
        src = src.repartition(int(num_partitions))
    key_fields = [src.schema[k] for k in keys]
    out_schema = T.StructType(
        key_fields
        + [
            T.StructField("response", T.StringType(), True),
            T.StructField("error", T.StringType(), True),
            T.StructField("attempts", T.IntegerType(), False),
        ]
    )

    def run(batches):
        def calls(batch):
            fns = [chat[name] for name in batch.column(model_col).to_pylist()] if isinstance(chat, dict) else [chat] * batch.num_rows
            return zip(fns, map(_as_messages, batch.column(messages_col).to_pylist()))

        if concurrency > 1:
            yield from _sliding(batches, calls, policy, concurrency, keys)
        else:
            for batch in batches:
                yield _replied(batch, keys, None, [policy.call(f, m) for f, m in calls(batch)])

    return src.mapInArrow(run, out_schema)


def _replied(batch, keys: Sequence[str], rows: Sequence[int] | None, results: Sequence[tuple]):
    """The given rows of a batch with their results; key columns stay Arrow arrays."""
    import pyarrow as pa

    columns = [batch.column(k) if rows is None else batch.column(k).take(pa.array(rows)) for k in keys]
    replies = [pa.array([r[i] for r in results], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.int32()))]
    return pa.RecordBatch.from_arrays([*columns, *replies], names=[*keys, "response", "error", "attempts"])


class CallWindow:
    """How many calls may be in flight: one more after a window of successes, half as many
    when the model's limit is hit (at least one, at most ``most``)."""

    def __init__(self, most: int):
        self.most, self.size = most, float(most)

    def succeeded(self) -> None:
        self.size = min(self.most, self.size + 1 / self.size)

    def failed(self, exc: BaseException) -> None:
        if retry_rate_limit(exc):
            self.size = max(1.0, self.size / 2)


#: Finished calls are passed on once there are so many.
PASSED_ON = 256


def _sliding(batches: Iterable, calls: Callable, policy: CallPolicy, concurrency: int, keys: Sequence[str], window: CallWindow | None = None) -> Iterator:
    """Replies in the order in which calls finish, with calls of several batches in flight.

    A batch is held only until its last call has finished."""
    window = window or CallWindow(concurrency)
    flying: dict[Future, tuple] = {}
    done: list[tuple] = []

    def passed_on():
        by_batch: dict[int, tuple] = {}
        for batch, row, result in done:
            by_batch.setdefault(id(batch), (batch, [], []))
            by_batch[id(batch)][1].append(row)
            by_batch[id(batch)][2].append(result)
        done.clear()
        return [_replied(batch, keys, rows, results) for batch, rows, results in by_batch.values()]

    def land():
        for future in wait(flying, return_when=FIRST_COMPLETED).done:
            result = future.result()
            if result[1] is None:
                window.succeeded()
            done.append((*flying.pop(future), result))

    with ThreadPoolExecutor(concurrency) as pool:
        for batch in batches:
            for row, (fn, messages) in enumerate(calls(batch)):
                while len(flying) >= int(window.size):
                    land()
                flying[pool.submit(policy.call, fn, messages, window.failed)] = batch, row
                if len(done) >= PASSED_ON:
                    yield from passed_on()
        while flying:
            land()
            if len(done) >= PASSED_ON:
                yield from passed_on()
        yield from passed_on()


def call_in_rounds(
    df: DataFrame,
    chat: Callable[[list[dict]], str] | dict[str, Callable[[list[dict]], str]],
    key_cols: Sequence[str],
    messages_col: str = "messages",
    model_col: str | None = None,
    policy: CallPolicy | None = None,
    concurrency: int = 1,
    num_partitions: int | None = None,
    path: str | None = None,
    pause: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """As ``batch_chat``, with each attempt a job of its own: no task waits between attempts.

    The work list is written once, with a number per call. A round tries every call that is
    due once and appends what came out; a call to be tried again gets a due time, the policy's
    delay with up to half of it more by chance (from its number, so the same in a repeated
    job), and waits in the table. Only the driver waits, until the first one is due, and then
    takes what is due within the policy's delay. So a task slot always calls or is free.
    """
    policy = policy or CallPolicy()
    spark, keys = df.sparkSession, list(key_cols)
    path = path or scratch_path(spark, "rounds")
    work = df.select(*keys, F.col(messages_col).alias("messages")).withColumn("__call", F.monotonically_increasing_id())
    work.write.parquet(f"{path}/work")
    work = spark.read.schema(work.schema).parquet(f"{path}/work")
    once = _Marked(policy)
    tries = ["__call", "__attempt", "response", "error", "again", "due"]
    schema = "__call bigint, __attempt int, response string, error string, again boolean, due double"
    due, turn, now = None, 0, 0.0
    while True:
        part = work.withColumn("__attempt", F.lit(1)) if due is None else work.join(due, "__call").withColumn("__attempt", F.col("__attempt") + 1)
        out = batch_chat(part, chat, ["__call", "__attempt", *([model_col] if model_col else [])], "messages", model_col, once, concurrency, num_partitions)
        marked = F.coalesce(F.col("error").startswith(_AGAIN), F.lit(False))
        delay = F.least(F.pow(F.lit(policy.backoff_base), F.col("__attempt") - 1), F.lit(policy.max_backoff)) if policy.backoff_base > 0 else F.lit(0.0)
        chance = F.pmod(F.xxhash64("__call", "__attempt"), F.lit(1000)) / 2000
        out = out.withColumns({
            "again": marked & (F.col("__attempt") < policy.max_attempts),
            "due": F.lit(now) + delay * (1 + chance),
            "error": F.when(marked, F.expr(f"substr(error, {len(_AGAIN) + 1})")).otherwise(F.col("error")),
        })
        out.select(*tries).write.parquet(f"{path}/tries/round={turn}")
        turn += 1
        every = spark.read.schema(schema).parquet(f"{path}/tries")
        last = every.groupBy("__call").agg(F.max_by(F.struct(*tries[1:]), "__attempt").alias("t")).select("__call", "t.*")
        waiting = last.filter("again")
        first = waiting.agg(F.min("due")).first()[0]
        if first is None:
            return work.select("__call", *keys).join(last, "__call").select(*keys, "response", "error", F.col("__attempt").alias("attempts"))
        pause(max(0.0, first - now))
        now = max(now, first)
        due_path = f"{path}/due/{turn}"
        waiting.filter(F.col("due") <= now + max(policy.backoff_base, 0.0)).select("__call", "__attempt").write.parquet(due_path)
        due = spark.read.schema("__call bigint, __attempt int").parquet(due_path)


#: Put before the error of a call that its policy would try again.
_AGAIN = "\u0001"


class _Marked(CallPolicy):
    """A policy of one attempt that marks errors to be tried again."""

    def __init__(self, policy: CallPolicy):
        super().__init__(1, 0.0, retryable=policy.retryable, fallback=policy.fallback)

    def call(self, chat, messages, failed=None):
        response, error, again = self.attempt(chat, messages)
        if again is not None:
            if failed:
                failed(again)
            error = _AGAIN + error
        return response, error, 1
