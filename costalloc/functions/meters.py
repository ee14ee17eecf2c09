"""What a billing meter charges for, read from its name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values, tried from top to bottom on the lower-cased meter name.
# (all of these words, cost type, token type)
COST_TYPES = [
    (["input", "token"], "Input Tokens", "Input"),
    (["output", "token"], "Output Tokens", "Output"),
    (["ptu"], "Provisioned Throughput", None),
    (["provisioned"], "Provisioned Throughput", None),
    (["fine-tuning"], "Fine-tuning", None),
    (["training"], "Training", None),
]
# Abbreviations seen in real exports; only used on request.
SHORT_COST_TYPES = [
    (["outp", "token"], "Output Tokens", "Output"),
    (["inp", "token"], "Input Tokens", "Input"),
]
# (all of these words, model family)
MODEL_FAMILIES = [
    (["gpt-5", "preview"], "GPT-5-Preview"),
    (["gpt-5", "turbo"], "GPT-5-Turbo"),
    (["gpt-5"], "GPT-5"),
    (["gpt-4o"], "GPT-4o"),
    (["gpt-4", "turbo"], "GPT-4-Turbo"),
    (["gpt-4"], "GPT-4"),
    (["gpt-3.5"], "GPT-3.5-Turbo"),
    (["gpt-35"], "GPT-3.5-Turbo"),
    (["davinci"], "Davinci"),
    (["curie"], "Curie"),
    (["ada"], "Ada"),
    (["babbage"], "Babbage"),
]
UNCLASSIFIED = "Unknown"


def _first_match(meter: str, rules: list[tuple[list[str], str | None]], default: str | None) -> Column:
    """The rules as one SQL CASE over the column `meter`."""

    def text(value: str | None) -> str:
        return "CAST(NULL AS STRING)" if value is None else f"'{value}'"

    cases = []
    for words, value in rules:
        hit = " AND ".join(f"contains(lower({meter}), '{word}')" for word in words)
        cases.append(f"WHEN {hit} THEN {text(value)}")
    return F.expr(f"CASE {' '.join(cases)} ELSE {text(default)} END")


def cost_type(meter: str, extended: bool = False) -> Column:
    rules = COST_TYPES + (SHORT_COST_TYPES if extended else [])
    return _first_match(meter, [(words, kind) for words, kind, _ in rules], UNCLASSIFIED)


def token_type(meter: str, extended: bool = False) -> Column:
    rules = COST_TYPES + (SHORT_COST_TYPES if extended else [])
    return _first_match(meter, [(words, token) for words, _, token in rules], None)


def model_family(meter: str) -> Column:
    return _first_match(meter, MODEL_FAMILIES, UNCLASSIFIED)
