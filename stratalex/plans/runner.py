"""Model runners: functions from a table of requests to a table of answers.

A runner is given its requests as a DataFrame and returns them with a column `answer` (JSON text, or null for a failed
call). Batches of requests meet the model in mapInPandas; answers are stored before use, because calls may differ when
Spark runs a task again."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.shared import cut

Runner = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class CallPolicy:
    attempts: int = 4
    backoff_seconds: float = 2.0
    constrained_hint: str = "Answer with JSON of the requested shape only."


def batch_runner(call: Callable[[str, dict], str], prompt: str, policy: CallPolicy = CallPolicy(), valid: Callable[[str], bool] | None = None, sleep: Callable[[float], None] = time.sleep) -> Runner:
    """Each request row becomes variables of one call of `call(prompt, variables)`. A failed or invalid answer is asked again
    with doubling pauses, once with the hint; what stays invalid has a null answer and an error."""

    def ask(variables: dict) -> tuple[str | None, str | None, int]:
        error, wait = None, policy.backoff_seconds
        for attempt in range(policy.attempts):
            try:
                said = call(prompt, variables | ({"hint": policy.constrained_hint} if error == "invalid-json" else {}))
                if (valid or is_json)(said):
                    return said, None, attempt + 1
                error = "invalid-json"
            except Exception as e:  # noqa: BLE001
                error = f"{type(e).__name__}: {e}"
            if attempt + 1 < policy.attempts:
                sleep(wait)
                wait *= 2
        return None, error, policy.attempts

    def run(requests: DataFrame) -> DataFrame:
        schema = T.StructType([*requests.schema.fields, T.StructField("answer", T.StringType()), T.StructField("error", T.StringType()), T.StructField("attempts", T.IntegerType())])

        def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                got = [ask(row) for row in batch.to_dict("records")]
                yield batch.assign(answer=[g[0] for g in got], error=[g[1] for g in got], attempts=[g[2] for g in got])

        return cut(requests.mapInPandas(each, schema), "answers")

    return run


def is_json(text: str | None) -> bool:
    try:
        json.loads(text or "")
    except ValueError:
        return False
    return True


def fixed(answer: str) -> Runner:
    """The same answer to every request."""
    return lambda requests: requests.withColumn("answer", F.lit(answer))


def expression(answer: Column) -> Runner:
    """A deterministic offline model: the answer is an expression of the request's columns."""
    return lambda requests: requests.withColumn("answer", answer)


def title_labels(words: int = 3) -> Runner:
    """Offline extraction: a record's first words are its one label."""
    said = F.array_join(F.slice(F.filter(F.split(F.trim("text"), r"\s+"), lambda t: t != ""), 1, words), " ")
    found = F.array(F.struct(said.alias("label"), F.lower(said).alias("normalized"), F.array().cast("array<string>").alias("aliases"), F.array("institution").alias("parents")))
    return lambda records: records.select("record_id", F.to_json(found).alias("answer"))


def render(template: str, variables: dict) -> str:
    """A template with {names}; a missing one is an error."""
    return template.format_map(_Strict(variables))


class _Strict(dict):
    def __missing__(self, key):
        raise KeyError(f"the template needs {key}")


@dataclass(frozen=True)
class Prompt:
    key: str
    variant: str
    template: str
    schema: str


class PromptRegistry:
    """Prompt variants by key, with one active each; deploying a variant keeps the one before."""

    def __init__(self, prompts: list[Prompt], active: dict[str, str] | None = None):
        self.prompts = {(p.key, p.variant): p for p in prompts}
        self.active = {p.key: p.variant for p in reversed(prompts)} | (active or {})
        self.before: dict[str, str] = {}

    def get(self, key: str) -> Prompt:
        if key not in self.active:
            raise KeyError(f"no prompt {key}; known: {sorted(self.active)}")
        return self.prompts[key, self.active[key]]

    def deploy(self, key: str, variant: str) -> None:
        if (key, variant) not in self.prompts:
            raise KeyError(f"no variant {variant} of {key}")
        self.before[key], self.active[key] = self.active[key], variant

    def roll_back(self, key: str) -> None:
        self.active[key] = self.before.pop(key)


PROMPTS = [
    Prompt("extract", "v1", "List the {level} entries named in this text of {institution} as JSON objects with label, normalized, aliases, parents:\n{text}", "array<struct<label:string,normalized:string,aliases:array<string>,parents:array<string>>>"),
    Prompt("verify", "v1", 'Is "{label}" alone a meaningful level {level} entry? Answer {{"pass": true or false, "reason": "..."}}', "struct<pass:boolean,reason:string>"),
    Prompt("disambiguate", "v1", 'Does "{label}" mean different things in these contexts? {contexts}', "struct<separable:boolean,confidence:double,senses:array<struct<label:string,gloss:string,parent_hints:array<string>,evidence_indices:array<int>>>>"),
    Prompt("validate", "v1", 'Do these passages support "{label}" at level {level}? {evidence}', "struct<validated:boolean,confidence:double,reason:string>"),
]
