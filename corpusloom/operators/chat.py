"""Model calls on rows: a replaceable chat client, retries, and one pass that runs a whole chain per row.

A chain is a function (client, row) -> dict of results. Few tasks with many threads each run it, so the cap on calls
holds for the whole query while what comes before runs at full width; a row is handed on when it is done, whatever the
rows before it wait for. Every result is a column, so a failing row never stops another. Calls cost money:
``run_saved`` appends results to a table batch by batch, and a run that was killed takes up what the table lacks.
"""

from __future__ import annotations

import http.client
import json
import random
import threading
import time
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from typing import Any, Protocol
from urllib.parse import urlsplit

import pandas as pd
from pyspark import AccumulatorParam
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..settings import Endpoint
from .tables import exists, new_path

# HTTP codes after which a call is repeated.
RETRYABLE = frozenset((408, 409, 425, 429, 500, 502, 503, 504))
#: What a model writes where the text is not to be rewritten.
SENTINEL = "|||"
#: Calls at a time in a task, at most; a larger cap takes more tasks. Rows of a result frame. Rows of a batch that is saved at once.
THREADS, FRAME_ROWS, BATCH_ROWS = 32, 64, 5_000


class ChatClient(Protocol):
    """Turns a prompt into text; '' where it finally failed. Must be picklable: each task has its own copy."""

    model: str

    def complete(self, prompt: str, step: int | str | None = None) -> str: ...


class HttpError(Exception):
    def __init__(self, code: int, retry_after: str | None = None):
        super().__init__(f"HTTP {code}")
        self.code, self.retry_after = code, retry_after


def content_text(content: Any) -> str:
    """The text of a reply's content: a string, a list of parts, or anything else by its string form; null is ''."""
    if isinstance(content, list):
        content = "".join(str(p.get("text") or "") if isinstance(p, dict) else str(p) for p in content)
    return "" if content is None else str(content).strip()


def retry_delay(endpoint: Endpoint, attempt: int, retry_after: str | None = None, jitter: float | None = None) -> float:
    """Seconds before the next attempt: what the server asks for, or a doubling wait with jitter; capped."""
    try:
        wanted = float(retry_after) if retry_after else None
    except ValueError:
        wanted = None
    if wanted is None:
        spread = random.random() if jitter is None else jitter
        wanted = endpoint.wait_seconds * 2**attempt + spread * endpoint.retry_jitter_seconds
    return min(wanted, endpoint.retry_max_delay)


_kept = threading.local()


def _connected(url, endpoint: Endpoint) -> http.client.HTTPConnection:
    kind = http.client.HTTPSConnection if url.scheme == "https" else http.client.HTTPConnection
    connection = kind(url.netloc, timeout=endpoint.connect_timeout)
    connection.connect()
    connection.sock.settimeout(endpoint.timeout)
    return connection


@dataclass
class HttpChat:
    """Client of a chat-completion service over the standard library. Each thread keeps one connection, so there are as many as calls at a time."""

    endpoint: Endpoint
    thinking: dict = field(default_factory=dict)
    sleep: Callable[[float], None] = time.sleep

    @property
    def model(self) -> str:
        return self.endpoint.model

    def payload(self, prompt: str, step: int | str | None = None) -> dict:
        e = self.endpoint
        out = {"model": e.model, "messages": [{"role": "user", "content": prompt}], "max_tokens": e.max_tokens, "temperature": e.temperature, "top_p": e.top_p, "stream": False}
        if step in self.thinking:
            out["chat_template_kwargs"] = {"enable_thinking": self.thinking[step]}
        return out

    def post(self, payload: dict) -> dict:
        """One request over this thread's kept connection; a connection that the server closed meanwhile is opened anew."""
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.endpoint.api_key}"} if self.endpoint.api_key else {})
        url, body = urlsplit(self.endpoint.base_url.rstrip("/") + "/chat/completions"), json.dumps(payload).encode()
        kept = _kept.__dict__.setdefault("connections", {})
        where = (url.scheme, url.netloc)
        while True:
            connection, used = kept.pop(where, (None, 0.0))
            if connection and time.monotonic() - used > self.endpoint.keepalive_expiry:
                connection.close()
                connection = None
            fresh = connection is None
            connection = connection or _connected(url, self.endpoint)
            try:
                connection.request("POST", url.path, body, headers)
                reply = connection.getresponse()
                text = reply.read()
            except (OSError, http.client.HTTPException):
                connection.close()
                if fresh:
                    raise
                continue
            if reply.will_close:
                connection.close()
            else:
                kept[where] = connection, time.monotonic()
            if reply.status >= 400:
                raise HttpError(reply.status, reply.headers.get("Retry-After"))
            return json.loads(text)

    def complete(self, prompt: str, step: int | str | None = None) -> str:
        payload = self.payload(prompt, step)
        for attempt in range(self.endpoint.max_retries):
            after = None
            try:
                if text := content_text(self.post(payload)["choices"][0]["message"].get("content")):
                    return text
            except HttpError as e:
                if e.code not in RETRYABLE:
                    return ""
                after = e.retry_after
            except (OSError, http.client.HTTPException, ValueError):
                pass  # transport errors and unreadable replies are repeated
            except Exception:
                return ""
            if attempt + 1 < self.endpoint.max_retries:
                self.sleep(retry_delay(self.endpoint, attempt, after))
        return ""


@dataclass
class FakeChat:
    """A deterministic client for tests and offline runs: answer is a pure function of prompt and step."""

    answer: Callable[[str, Any], str]
    model: str = "fake-model"

    def complete(self, prompt: str, step: int | str | None = None) -> str:
        return self.answer(prompt, step)


class _Greatest(AccumulatorParam):
    def zero(self, value: int) -> int:
        return 0

    def addInPlace(self, a: int, b: int) -> int:
        return max(a, b)


class RunCounters:
    """Rows completed and failed, and the greatest number of calls at a time in one task. A task that is repeated counts again."""

    def __init__(self, spark: SparkSession):
        new = spark.sparkContext.accumulator
        self.completed, self.failed, self.in_flight = new(0), new(0), new(0, _Greatest())

    def as_dict(self) -> dict[str, int]:
        return {"completed": self.completed.value, "failed": self.failed.value, "max_in_flight": self.in_flight.value}


class _Gauge:
    """A client that knows how many of its calls run."""

    def __init__(self, client: ChatClient):
        self.client, self.model, self.lock, self.now, self.most = client, client.model, threading.Lock(), 0, 0

    def complete(self, prompt: str, step: int | str | None = None) -> str:
        with self.lock:
            self.now += 1
            self.most = max(self.most, self.now)
        try:
            return self.client.complete(prompt, step)
        finally:
            with self.lock:
                self.now -= 1


def _as_they_come(work: Callable[[dict], dict], rows: Iterator[dict], threads: int) -> Iterator[tuple[dict, dict]]:
    """(row, result) in the order in which the results come; only twice as many rows as threads are taken ahead."""
    waiting: dict = {}
    with ThreadPoolExecutor(threads) as pool:
        for row in rows:
            waiting[pool.submit(work, row)] = row
            if len(waiting) >= 2 * threads:
                for done in wait(waiting, return_when=FIRST_COMPLETED).done:
                    yield waiting.pop(done), done.result()
        while waiting:
            for done in wait(waiting, return_when=FIRST_COMPLETED).done:
                yield waiting.pop(done), done.result()


def run_chain(df: DataFrame, client: ChatClient, chain: Callable[[ChatClient, dict], dict], results: T.StructType | str, max_in_flight: int = 4, counters: RunCounters | None = None) -> DataFrame:
    """df with the columns of results, from chain for each row, in any order; an error in chain is a bug and ends the query.

    max_in_flight holds for the whole query: as few tasks as THREADS allows share the cap as threads. The rows are
    shuffled to these tasks, so that scans and functions before them keep their own parallelism.
    """
    added = T._parse_datatype_string(results) if isinstance(results, str) else results
    schema = T.StructType([*df.schema.fields, *added.fields])
    names = schema.fieldNames()
    tasks = max(1, -(-max_in_flight // THREADS))
    threads = max(1, max_in_flight // tasks)

    def run(batches):
        gauge, ready = _Gauge(client), []
        rows = (row for batch in batches for row in batch.to_dict("records"))
        for row, result in _as_they_come(lambda row: chain(gauge, row), rows, threads):
            ready.append({**row, **result})
            if counters is not None:
                (counters.completed if result.get("error") is None else counters.failed).add(1)
            if len(ready) == FRAME_ROWS:
                yield pd.DataFrame(ready, columns=names, dtype=object)
                ready = []
        if ready:
            yield pd.DataFrame(ready, columns=names, dtype=object)
        if counters is not None:
            counters.in_flight.add(gauge.most)

    return df.repartition(tasks).mapInPandas(run, schema)


def run_saved(
    df: DataFrame, client: ChatClient, chain: Callable[[ChatClient, dict], dict], results: T.StructType | str, path: str, keys: list[str], max_in_flight: int = 4, batch_rows: int = BATCH_ROWS, counters: RunCounters | None = None
) -> DataFrame:
    """As run_chain, with the results in a table at path, appended in batches of about batch_rows rows.

    A row whose keys (null equals null) the table has is not called again, so a run that was killed loses the calls
    of one batch at most. Rows with equal keys are called once and share the result.
    """
    spark = df.sparkSession
    added = T._parse_datatype_string(results) if isinstance(results, str) else results
    stored = T.StructType([T.StructField("_call", T.StringType()), *added.fields])
    rows = df.withColumn("_call", F.md5(F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})))
    todo = rows.dropDuplicates(["_call"])
    if exists(spark, path):
        todo = todo.join(spark.read.schema(stored).parquet(path).select("_call"), "_call", "left_anti")
    else:
        spark.createDataFrame([], stored).write.parquet(path)
    todo_path = new_path(spark, "calls")
    todo.write.parquet(todo_path)
    todo = spark.read.schema(rows.schema).parquet(todo_path)
    batches = -(-todo.count() // batch_rows)
    if batches > 1:
        spread = new_path(spark, "batches")
        todo.withColumn("_batch", F.pmod(F.xxhash64("_call"), F.lit(batches)).cast("int")).write.partitionBy("_batch").parquet(spread)
        todo = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("_batch", T.IntegerType())])).parquet(spread)
    for n in range(batches):
        part = (todo.where(F.col("_batch") == n) if batches > 1 else todo).select(*rows.columns)
        run_chain(part, client, chain, added, max_in_flight, counters).select(*stored.fieldNames()).write.mode("append").parquet(path)
    return rows.join(spark.read.schema(stored).parquet(path).dropDuplicates(["_call"]), "_call").drop("_call")
