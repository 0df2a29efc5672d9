"""Language models as a pluggable step: prompts made in Spark, calls in Arrow batches, with retries.

A call is a function of a payload (model, prompt, and ``format`` where JSON is asked for) and a time limit. What a model
can't answer is a row with an error; other rows go on."""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Seconds to wait before another try. Fixed values.
DELAYS = (2.0, 5.0, 10.0)
EXTRACT_S, VERIFY_S = 300, 180
Call = Callable[[dict, float], str]


def http_call(url: str) -> Call:
    """A call that posts to a server which answers with a JSON object that has ``response``."""

    def call(payload: dict, timeout: float) -> str:
        request = urllib.request.Request(url, json.dumps({**payload, "stream": False}).encode(), {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=timeout) as answer:  # noqa: S310  the caller's own server
            return (json.loads(answer.read()).get("response") or "").strip()

    return call


def is_alive(url: str, timeout: float = 5.0) -> bool:
    """Whether a server answers at all."""
    try:
        with urllib.request.urlopen(url, timeout=timeout) as answer:  # noqa: S310
            return answer.status < 500
    except OSError:
        return False


def with_retry(call: Call, payload: dict, timeout: float, delays: tuple[float, ...] = DELAYS) -> tuple[str | None, int, str | None]:
    """(answer, tries, error): tried again after an empty answer or a failure, but not where no server is there."""
    error = None
    for n, delay in enumerate(delays, 1):
        try:
            if answer := call(payload, timeout):
                return answer, n, None
            error = "empty answer"
        except ConnectionError as failed:
            return None, n, f"not reachable: {failed}"
        except Exception as failed:  # a model's failure is data
            error = f"{type(failed).__name__}: {failed}"
        if n < len(delays):
            time.sleep(delay)
    return None, len(delays), error


def ask(rows: DataFrame, prompt: str, call: Call, model: str, as_json: bool = True, timeout: float = EXTRACT_S, delays: tuple[float, ...] = DELAYS) -> DataFrame:
    """rows (doc_id, prompt, ...) with answer, tries and error."""
    kind = dict(rows.dtypes)["doc_id"]

    def answers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [with_retry(call, {"model": model, "prompt": p} | ({"format": "json"} if as_json else {}), timeout, delays) for p in batch["prompt"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "answer": [g[0] for g in got], "tries": [g[1] for g in got], "error": [g[2] for g in got]})

    return rows.select("doc_id", F.col(prompt).alias("prompt")).mapInPandas(answers, f"doc_id {kind}, answer string, tries int, error string")


def block_prompt(text: Column, labels: tuple[str, ...], fields: tuple[str, ...]) -> Column:
    """A prompt that asks for a block's rows as JSON, each with its number and fields."""
    rows = "\n".join(f"{k}. {label}" for k, label in enumerate(labels, 1))
    head = f"Read these rows from the statement and answer with a JSON array of objects with sl_no, {', '.join(fields)}. Use 0 where there is no amount.\n{rows}\nStatement:\n"
    return F.concat(F.lit(head), F.coalesce(text, F.lit("")))


def verify_prompt(label: Column, value: Column, text: Column) -> Column:
    """A prompt that asks whether an amount is what a text says of a label."""
    return F.concat(F.lit("Answer yes or no: does the statement give "), value.cast("string"), F.lit(" for "), label, F.lit("?\nStatement:\n"), F.coalesce(text, F.lit("")))
